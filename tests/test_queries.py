"""Every query with SQL against DuckDB on the same tables, as sorted rows."""

import duckdb
import pytest

from veilframe.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 5) if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, db, name):
    got = registry.queries()[name](spark, SF)
    rows = got.collect()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns) > 0
        return
    want = db.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    key = lambda r: tuple(plain(r[c]) for c in sorted(names))
    assert sorted(map(str, map(key, [r.asDict() for r in rows]))) == sorted(map(str, map(key, [dict(zip(names, r, strict=True)) for r in want.fetchall()])))


def test_entry_points(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
