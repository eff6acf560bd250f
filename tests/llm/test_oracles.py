"""The queries of this folder that have SQL, against DuckDB on the same tables; and that SQL on hard rows."""

import duckdb
import pytest

from veilframe.llm import dart_minhash, oracles, queries, url_trust

SF = "/root/testdata/sf0.001"


def shown(rows, names):
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(str([plain(r[c]) for c in sorted(names)]) for r in rows)


def by_sql(con, sql):
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    return names, [dict(zip(names, r, strict=True)) for r in got.fetchall()]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    names, want = by_sql(con, queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert shown(got.collect(), names) == shown(want, names)


def test_ranks_of_linked_hosts_equal_sql(spark):
    """Links between hosts in a ring, out of seeds of both kinds, repeated links, odd and missing urls."""
    links = {"a.org": ["b.net", "b.net", "c.net"], "b.net": ["c.net", "bad.com"], "c.net": ["a.org"], "x.net": ["bad.com"], "bad.com": ["y.net"], "y.net": ["x.net"], "lone.net": []}
    rows = [(i, f"http://{h}{'/de/q' if h == 'bad.com' else '/q'}?z#z", "".join(f"<a href='//{t}/z'>" for t in ts)) for i, (h, ts) in enumerate(links.items())]
    rows += [(100, None, "x"), (101, "no scheme", None), (102, "HTTP://WWW.Example.ORG/en/12", ""), (103, "http://example.org/es/1", None), (104, "http://", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    con = duckdb.connect()
    con.register("pages", df.toArrow())
    names, want = by_sql(con, oracles.URL_TRUST)
    got = url_trust.judge(df).collect()
    assert shown(got, ["page_id", "host", "path", "rule", "verdict"]) == shown(want, ["page_id", "host", "path", "rule", "verdict"])
    ranks = {w["page_id"]: w for w in want}
    for r in got:
        assert r.trust == pytest.approx(ranks[r.page_id]["trust"], abs=1e-6) and r.distrust == pytest.approx(ranks[r.page_id]["distrust"], abs=1e-6)


def test_near_duplicates_equal_sql_on_hard_rows(spark):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base), " ".join(base[:-2]), " ".join(base[:-4]), " ".join(["x", *base[3:]]), " ".join(base).upper(), "", None, " \t", "a b", "a  b", "b a", "a b c d", "a a a a a a a a a", "a a a a a a a a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(50, texts[0])], "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    names, want = by_sql(con, oracles.NEAR_DUPLICATES)
    assert shown(dart_minhash.near_duplicates(df).collect(), names) == shown(want, names)
