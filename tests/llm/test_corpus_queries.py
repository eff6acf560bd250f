"""URL rules and trust, toxicity, mixing and SpotSigs, against plain Python."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from veilframe.llm import mixing, queries, spotsigs, toxicity, url_trust
from veilframe.llm.common import Scratch

SF = "/root/testdata/sf0.01"


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group(0)
    return "".join(c.lower() if c.isascii() else c for c in host), re.match(r"[^?#]*", rest[len(host) :]).group(0)


def rule_of(host, path):
    fits = [r for r in url_trust.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def test_rules_and_parts(spark):
    urls = ["http://A.Example.ORG/es/x?q#f", "x://example.org/en/12#f", "https://b.org", "b.org/x", None, "", "http://x.com/fr/?a", "http://ÄX.com/de/", "u://h://i/p", "http://notexample.org/es/", "http://com/de/x", "http://q?x/://y/"]
    df = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_trust.judge(df).collect()}
    for i, u in enumerate(urls):
        host, path = parts(u)
        r = rule_of(host, path)
        assert got[i][:3] == (host, path, r and r.name)
        assert r is None or got[i][3] == r.verdict
    assert url_trust.judge(df.limit(0)).count() == 0


def test_ranks_and_verdicts_follow_links(spark):
    hosts = {"a.org": ["b.net"], "b.net": ["c.net"], "c.net": [], "x.net": ["bad.com"], "bad.com": [], "y.net": ["x.net", "b.net"]}
    rows = [(h, p, "".join(f"<a href='http://{t}/z'>" for t in ts) + '<a href="/own">') for h, ts in hosts.items() for p in (["/de/q"] if h == "bad.com" else ["/q"])]
    df = spark.createDataFrame([(i, f"http://{h}{p}", html) for i, (h, p, html) in enumerate(rows)], "page_id long, url string, html string")
    got = {r.host: r for r in url_trust.judge(df, rounds=6).collect()}

    def rank(seed, edges):
        r = dict(seed)
        for _ in range(6):
            new = {h: 0.15 * m for h, m in seed.items()}
            for s, ts in edges.items():
                for t in ts:
                    new[t] = new.get(t, 0) + 0.85 * r.get(s, 0) / len(ts)
            r = new
        total = sum(r.values())
        return {h: x / total for h, x in r.items()}

    back = {}
    for s, ts in hosts.items():
        for t in ts:
            back.setdefault(t, []).append(s)
    trust, distrust = rank({"a.org": 1.0}, hosts), rank({"bad.com": 1.0}, back)
    for h, r in got.items():
        assert r.trust == pytest.approx(trust.get(h, 0), abs=1e-9) and r.distrust == pytest.approx(distrust.get(h, 0), abs=1e-9)
    assert {h: r.verdict for h, r in got.items()} == {"a.org": "allow", "b.net": "allow", "c.net": "allow", "x.net": "block", "bad.com": "block", "y.net": "block"}


def test_ranks_reach_the_end_of_a_long_chain(spark):
    """A host 30 links from a blocked seed, and none from a trusted one, is blocked; ranks are those of a linear system."""
    n = 30
    rows = [(i, f"http://h{i}.net/q", f"<a href='http://h{i + 1}.net/'>") for i in range(n)] + [(n, f"http://h{n}.net/q", "<a href='http://bad.com/de/q'>"), (n + 1, "http://bad.com/de/q", None), (n + 2, "http://alone.net/", None), (n + 3, None, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.host: r for r in url_trust.judge(df).collect()}
    assert [h for h, r in got.items() if r.verdict == "allow"] and {h for h, r in got.items() if r.verdict == "allow"} == {"alone.net", ""}
    want = {"bad.com": 0.15} | {f"h{n - k}.net": 0.15 * 0.85 ** (k + 1) for k in range(n + 1)}
    total = sum(want.values())
    assert all(got[h].distrust == pytest.approx(x / total, abs=1e-6) for h, x in want.items())


def test_toxicity_finds_held_out(spark):
    sf = "/root/testdata/sf0.1"  # enough examples of each language
    got = queries.op4_toxicity(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(got) == docs.count()
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()
    x = got[got["held_out"]].merge(labels, on="doc_id")
    assert ((x["predicted"] == 1) == (x["toxic"] == 1)).mean() > 0.98
    clean = x[x["toxic"] == 0]
    assert clean["predicted"].mean() < 0.01 and x[x["toxic"] == 1]["predicted"].mean() > 0.9


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, 9), (2, "", 9), (None, "idiot", 9)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.judge(docs, none).collect()
    assert len(got) == 3 and all(r.predicted == 0 for r in got)
    assert toxicity.judge(docs.limit(0), none).count() == 0
    kept = toxicity.score(docs, toxicity.fit(docs, none))
    assert kept.columns == ["doc_id", "text", "score", "predicted"]


def test_toxicity_counts_all_documents(spark):
    df = spark.range(13_000).selectExpr("if(id % 1000 = 0, 'abcd efgh', 'abcd') AS text").select(toxicity.words("text").alias("w"))
    values = np.sort(np.frombuffer(b"abcd\0\0\0\0efgh\0\0\0\0", np.uint64))
    counts, rows = toxicity.document_frequencies(df, values)
    assert rows == 13_000 and sorted(counts) == [13, 13_000]


def test_pieces_equal_plain_python(monkeypatch):
    monkeypatch.setattr(toxicity, "CHUNK", 64)
    texts = [" idiot the idiots ", "  ", " ß ", " über " * 3, "", " abcdefghijk ", " aaaa " * 40]
    data, offsets = toxicity._bytes(pa.array(["skipped", *texts]).slice(1))
    own = [{t.encode()[i : i + n] for n in toxicity.SIZES for i in range(len(t.encode()) - n + 1)} for t in texts]
    number = lambda b: int.from_bytes(b, "little")
    values = np.array(sorted({number(b) for x in own for b in x}), np.uint64)
    some = values[::3]
    rows, numbers = toxicity.Finder(some).find(data, offsets)
    want = [(r, k) for r, x in enumerate(own) for k in sorted(np.flatnonzero(np.isin(some, np.array([number(b) for b in x], np.uint64))))]
    assert list(zip(rows, numbers, strict=True)) == want
    monkeypatch.setattr(toxicity, "CHUNK", 1 << 18)
    ((found, n),) = toxicity.pieces(data, offsets)
    assert dict(zip(found.tolist(), n.tolist(), strict=True)) == {v: sum(any(number(b) == v for b in x) for x in own) for v in values.tolist()}


def test_toxicity_knows_stems_and_letters_set_apart(spark):
    """Words that no example had: fresh endings of known stems, and known words whose letters stand apart."""
    g = np.random.default_rng(1)
    syllables = ["ba", "do", "ke", "li", "mu", "ra", "so", "ti", "ve", "zu"]
    word = lambda k: "".join(g.choice(syllables, k))
    plain = lambda n: [word(g.integers(2, 4)) for _ in range(n)]

    def bad(end):
        return "grolf" + end

    docs, labels = [], []
    for i in range(1_500):
        w, toxic = plain(60), i % 6 == 0
        if toxic:
            for k in g.integers(0, 60, 3):
                w[k] = bad(word(1))
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    new = [" ".join(["x", *plain(30), bad("ist"), *plain(30)]) for _ in range(40)] + [" ".join([*plain(30), "g r o l f b a", *plain(30)]) for _ in range(40)]
    clean = [" ".join(plain(60)) for _ in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = toxicity.score(spark.createDataFrame([(i, t) for i, t in enumerate(new + clean)], "doc_id long, text string"), model).toPandas().set_index("doc_id")
    limit = got["score"][80:].quantile(0.9)
    assert (got["score"][:80] > limit).mean() > 0.9 and (got["predicted"][80:] == 1).mean() < 0.05


def test_toxicity_keeps_columns_of_its_own_names(spark):
    docs = spark.createDataFrame([(1, "a", 7.5, 3, "q"), (2, None, 1.5, 4, None)], "doc_id long, text string, score double, Predicted int, __score string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.clean(docs, none)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [(1, "a", 7.5, 3, "q"), (2, None, 1.5, 4, None)]


def test_nnpu_corrects_for_positives_in_the_unlabelled():
    g = np.random.default_rng(0)

    def doc(toxic):
        return np.flatnonzero(np.concatenate([g.random(5) < (0.6 if toxic else 0.02), g.random(20) < 0.3]))

    pos, unl = [doc(1) for _ in range(300)], [doc(g.random() < 0.3) for _ in range(2000)]
    w = toxicity.nnpu(toxicity.Examples.of(pos), toxicity.Examples.of(unl), 0.3, 25)
    hit = [w[doc(1)].sum() + w[25] > 0 for _ in range(500)]
    miss = [w[doc(0)].sum() + w[25] > 0 for _ in range(500)]
    assert np.mean(hit) > 0.9 and np.mean(miss) < 0.15


def water(sizes, weights, share=1.5, most=2.0):
    target, left = {}, dict(weights)
    total = share * sum(sizes.values())
    while left:
        level = (total - sum(target.values())) / sum(left.values())
        over = [s for s in left if level * left[s] > most * sizes[s]]
        if not over:
            return target | {s: level * w for s, w in left.items()}
        for s in over:
            target[s] = most * sizes[s]
            del left[s]
    return target


def test_mixing_meets_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source").toPandas()
    extra = [(2**62 + 1, "x y", "src0"), (900_001, None, "src0"), (900_002, "", None), (900_003, "a b c", None), (900_004, "a\x0bb\u00a0c d", ""), (900_005, "one", "z\U0001f600"), (900_006, "one two", "z\uffee")]
    df = spark.createDataFrame([*map(tuple, docs.itertuples(index=False)), *extra], "doc_id long, text string, source string")
    got = mixing.taken(df).toPandas()
    again = mixing.taken(df.repartition(5, "text")).toPandas()
    key = ["doc_id", "taken"]
    assert got[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()
    rows = [(r.doc_id, len(re.findall(r"[^\x20\x09-\x0d]+", r.text or "")), r.source) for r in df.collect()]
    sizes = {}
    for _, n, s in rows:
        sizes[s] = sizes.get(s, 0) + n
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = water(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)})
    by = {r.doc_id: r for r in got.rename(columns={"size": "n_words"}).itertuples()}
    sums = dict.fromkeys(sizes, 0)
    for i, n, s in rows:
        r = by[i]
        assert (r.n_words, r.source_size) == (n, sizes[s])
        assert r.target == pytest.approx(goal[s]) and r.taken <= 2 * n and (n == 0 or r.taken % n == 0)
        sums[s] += r.taken
    for s in sizes:
        assert abs(sums[s] - goal[s]) <= max(n for _, n, t in rows if t == s)
    assert mixing.taken(df.limit(0)).count() == 0
    null_ids = spark.createDataFrame([(None, "a b", "s"), (None, "c", "s"), (2**62 + 1, "d e f", "s")], "doc_id long, text string, source string")
    assert sorted(str(r.doc_id) for r in mixing.taken(null_ids).collect()) == ["4611686018427387905", "None", "None"]


def test_tree_of_several_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 8)
    monkeypatch.setattr(mixing, "FAN", 3)
    df = spark.createDataFrame([(i, "w " * (1 + i % 7), "s") for i in range(100)] + [(5, "w " * 6, "s")] * 3, "doc_id long, text string, source string")
    got = mixing.taken(df).toPandas()
    assert len(got) == 103 and abs(got["taken"].sum() - got["target"].iloc[0]) <= 24


def test_pivot_keeps_mass_and_expectation():
    g = np.random.default_rng(3)
    mass, part = g.integers(1, 50, 200).astype(float).tolist(), g.random(200).tolist()
    want, mean = sum(m * p for m, p in zip(mass, part, strict=True)), np.zeros(200)
    for k in range(400):
        out = mixing.pivot(mass, part, str(k))
        assert sum(m * p for m, p in zip(mass, out, strict=True)) == pytest.approx(want)
        assert sum(p not in (0, 1) for p in out) <= 1
        mean += out
    assert np.abs(mean / 400 - part).mean() < 0.03


def test_apply_mix_repeats_rows(spark):
    df = spark.createDataFrame([(i, "w " * (i % 9), f"s{i % 3}", "x") for i in range(100)], "doc_id long, text string, source string, copies string")
    want = {(r.doc_id, r.taken) for r in mixing.taken(df).collect() if r.taken}
    out = mixing.apply_mix(df)
    assert out.columns == df.columns
    got = out.filter("doc_id % 9 > 0").groupBy("doc_id").count().collect()
    assert {(r.doc_id, r["count"] * (r.doc_id % 9)) for r in got} == want


def sigs(text):
    common = set(spotsigs.ANCHORS)
    w = [x for x in re.split(r"[\W_]+", text.lower()) if x]
    out = set()
    for i, x in enumerate(w):
        if x in common:
            follow = [y for y in w[i + 1 : i + 1 + spotsigs.REACH] if y not in common][: spotsigs.CHAIN]
            if len(follow) == spotsigs.CHAIN:
                out.add((x, *follow))
    return out or {(x,) for x in w}


def likeness(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


@pytest.mark.parametrize("bucket", [2000, 7])
def test_edits_equal_plain_python(spark, monkeypatch, bucket):
    monkeypatch.setattr(spotsigs, "BUCKET", bucket)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(10**6, None), (10**6 + 7, ""), (10**7, "the cat sat 😀 on a mat"), (-5, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in spotsigs.edits(df).collect()}
    rows.sort(key=lambda r: -r[0])
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        m = len(t) // 3
        edited = t[: len(t) - m] + nxt[:m]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(likeness(sigs(t), sigs(edited))) and r.near_next == pytest.approx(likeness(sigs(t), sigs(nxt)))


def test_edits_of_few_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "c"), (4, "the end of all things here"), (4, "same id")], "doc_id long, text string")
    assert spotsigs.edits(df).count() == 4
    assert spotsigs.edits(df.limit(0)).count() == 0
    one = spotsigs.edits(df.limit(1)).first()
    assert one.near_next == 1.0


def test_near_pairs_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    x = spotsigs.fingerprint(docs)
    want, seen = set(), {}
    for r in docs.collect():
        s = frozenset(sigs(r.text or ""))
        if s:
            seen[s] = min(seen.get(s, r.doc_id), r.doc_id)
    items = list(seen.items())
    for k, (a, i) in enumerate(items):
        for b, j in items[:k]:
            if len(a & b) >= 0.8 * len(a | b):
                want.add((min(i, j), max(i, j)))
    assert {(r.a, r.b) for r in spotsigs.near_pairs(x).collect()} == want
    assert len(want) > 0


def test_scratch_drops(spark):
    s = Scratch(spark, "x")
    a, b = s.keep(spark.range(3)), s.keep(spark.range(4))
    s.drop(a)
    assert b.count() == 4
    s.drop()
