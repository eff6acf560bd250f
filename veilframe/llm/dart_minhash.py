"""Near duplicates by weighted MinHash signatures from darts, banded joins, and an exact check.

An element (a run of five words, its count the weight) is a strip of area weight x infinity, cut into regions of doubling
width along the weight. Hashed darts fall into every region at a constant rate, in order of their rank; those of a text are
the darts within its elements' weights and below a rank at which about K ln K + 2 K of them have fallen. Each dart has one of
K coordinates by its hash, and the earliest of a coordinate is the text's value there. Two texts have the same value with the
probability of their weighted Jaccard; the work is linear in elements and darts, not elements times K.

Texts that share a band of values are candidates. A bucket isn't expanded to pairs: its members are checked against its
most central text, its middle, first, and links give classes. What is still apart in a bucket goes on, with more centres in
each round until all are. A pair is left out only where it can't be near: its elements that others have are too few, or the
middle's elements that one has and the other lacks too many, or their distances from the middle differ too much.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import Scratch, fresh, release, text_of

#: Words of an element; least weighted Jaccard of near duplicates.
SHINGLE, THRESHOLD = 5, 0.8
#: Bands and values in a band: a pair at the threshold shares a band with probability 1 - (1 - 0.8 ** 5) ** 25 = 0.99995.
BANDS, ROWS = 25, 5
#: Words and texts worked on at once.
BLOCK_WORDS, BLOCK_TEXTS = 250_000, 500
#: Centres of a bucket in the second round, and how many times as many in each one after.
CENTRES, MORE = 8, 16
#: Words of 64 bits that say which elements of a bucket's middle a text has.
LONGS = 4
BITS = [f"bits{j}" for j in range(LONGS)]
#: Pairs of one text that a task gets together.
SPREAD = 1_000

#: Hash slots by which texts without a candidate partner are told apart before they would be moved.
SLOTS = 1 << 18

_U = np.uint64
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], _U)
ELEMENT_BITS = 50


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input changes half of the output's."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1]."""
    return ((x >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53


@np.errstate(over="ignore")
def elements(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, elements (sorted within a row) and weights of texts given by their words' hashes; a text of fewer than SHINGLE
    words is one element."""
    h, n = words.view(_U), np.diff(offsets)
    many = np.maximum(n - SHINGLE + 1, 0)
    rows = np.repeat(np.arange(len(n)), many)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(offsets[:-1], many)
    x = np.zeros(len(at), _U)
    for k in range(SHINGLE):
        x = mix(x + h[at + k] * _STEPS[k])
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        own = np.zeros(len(short), _U)
        for j, r in enumerate(short.tolist()):
            v = np.array([n[r]], _U)
            for w in h[offsets[r] : offsets[r + 1]]:
                v = mix(v * _STEPS[0] + w)
            own[j] = v[0]
        rows, x = np.concatenate([rows, short]), np.concatenate([x, own])
    shift = _U(64 - ELEMENT_BITS)
    key = np.sort((rows.astype(_U) << _U(ELEMENT_BITS)) | (x >> shift))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
    weights = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> _U(ELEMENT_BITS)).astype(np.int64), key & _U((1 << ELEMENT_BITS) - 1), weights


@np.errstate(over="ignore")
def signatures(rows: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int = BANDS * ROWS, seed: int = 0) -> np.ndarray:
    """n x k values of weighted sets given as rows, elements and positive weights (real numbers); 0 for a row without any."""
    rank, value = np.full(n * k, np.inf), np.zeros(n * k, _U)
    total = np.bincount(rows, weight, n)
    darts = k * np.log(k) + 2 * k
    todo = total > 0
    limit = np.where(todo, darts / np.where(todo, total, 1.0), 0.0)
    salt = mix(np.array([seed + 1], _U))[0]
    while todo.any():
        live = todo[rows]
        r0, e0, w0 = rows[live], element[live], weight[live]
        region = 0
        while len(r0):
            low, width = float((1 << region) - 1), float(1 << region)
            r, w, at = r0, w0, np.zeros(len(r0))
            base, k_dart = mix(e0 + salt + _U(region) * _STEPS[1]), 0
            own_limit = limit[r]
            while len(r):
                d = mix(base + _U(k_dart) * _STEPS[2])
                at = at - np.log(unit(d)) / width
                near = at < own_limit
                if not near.all():
                    r, w, at, base, d, own_limit = r[near], w[near], at[near], base[near], d[near], own_limit[near]
                inside = low + width * unit(mix(d ^ _STEPS[3])) <= w
                v = mix(d ^ _STEPS[4])
                cell = r * k + (v % _U(k)).astype(np.int64)
                cell, v, a = cell[inside], v[inside], at[inside]
                np.minimum.at(rank, cell, a)
                best = a == rank[cell]
                value[cell[best]] = v[best]
                k_dart += 1
            region += 1
            more = w0 > (1 << region) - 1
            r0, e0, w0 = r0[more], e0[more], w0[more]
        # a text with an empty coordinate throws on, twice as far
        todo &= np.isinf(rank.reshape(n, k)).any(axis=1)
        limit = np.where(todo, limit * 2, limit)
    return value.reshape(n, k)


@np.errstate(over="ignore")
def bands_of(values: np.ndarray, bands: int = BANDS) -> np.ndarray:
    n, k = values.shape
    x, cut = np.zeros((n, bands), _U) + np.arange(bands, dtype=_U) * _STEPS[1], values.reshape(n, bands, k // bands)
    for j in range(k // bands):
        x = mix(x * _STEPS[0] + cut[:, :, j])
    return x.view(np.int64)


def word_hashes(text: str | Column) -> Column:
    """Hashes of the words between white space, in lower case."""
    return F.transform(F.filter(F.split(F.lower(text_of(text)), r"\s+"), lambda w: w != ""), lambda w: F.xxhash64(w))


def _pieces(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a batch with bounded words: start, end, word hashes, offsets from 0."""
    c = batch.column(column)
    values, offsets, lo = c.values.to_numpy(), c.offsets.to_numpy().astype(np.int64), 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + BLOCK_WORDS, side="right")) - 1
        hi = min(max(hi, lo + 1), lo + BLOCK_TEXTS, batch.num_rows)
        yield lo, hi, values[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))


def sign(docs: DataFrame) -> DataFrame:
    """From doc_id, node, text: doc_id, node, weight (elements, repeats counted), bands (empty for a text without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words, offsets in _pieces(batch, "words"):
                rows, element, weight = elements(words, offsets)
                n = hi - lo
                total = np.bincount(rows, weight, n).astype(np.int64)
                found = bands_of(signatures(rows, element, weight.astype(float), n))
                has = total > 0
                part = batch.slice(lo, n)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("node"), pa.array(total), _lists(found[has].ravel(), np.where(has, BANDS, 0), pa.int64())], names=["doc_id", "node", "weight", "bands"])
        release()

    return docs.select("doc_id", "node", word_hashes("text").alias("words")).mapInArrow(run, "doc_id long, node binary, weight long, bands array<long>")


def contents(docs: DataFrame) -> DataFrame:
    """From node, text: node, elements (sorted), counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words, offsets in _pieces(batch, "words"):
                rows, element, weight = elements(words, offsets)
                sizes = np.bincount(rows, minlength=hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(lo, hi - lo), _lists(element.view(np.int64), sizes, pa.int64()), _lists(weight, sizes, pa.int32())], names=["node", "elements", "counts"])
        release()

    return docs.select("node", word_hashes("text").alias("words")).mapInArrow(run, "node binary, elements array<long>, counts array<int>")


def weighted_jaccard(a: np.ndarray, ac: np.ndarray, b: np.ndarray, bc: np.ndarray) -> float:
    """Of two weighted sets with sorted elements."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    hit = b[at] == a
    both = int(np.minimum(ac[hit], bc[at[hit]]).sum())
    return both / (int(ac.sum()) + int(bc.sum()) - both)


def spread(pairs: DataFrame, known: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs a, b with both texts' columns, named a_.. and b_..; the rows of a frequent b are dealt out with copies of its columns."""
    often = pairs.groupBy("b").agg(F.count("*").alias("n")).filter(F.col("n") > SPREAD).select("b", F.ceil(F.col("n") / SPREAD).cast("int").alias("parts"))
    side = lambda k: known.select(F.col("node").alias(k), *(F.col(c).alias(f"{k}_{c}") for c in columns))
    parts = F.coalesce("parts", F.lit(1))
    left = pairs.join(often, "b", "left").select("a", "b", F.pmod(F.xxhash64("a"), parts).cast("int").alias("part")).join(side("a"), "a")
    right = side("b").join(often, "b", "left").select("b", *(f"b_{c}" for c in columns), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    return left.join(right, ["b", "part"])


def compared(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs a, b with their weighted Jaccard, and which of b's first 64 * LONGS elements a has, a bit each."""
    names = ["a", "b", "jaccard", *BITS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [(c.values.to_numpy(), c.offsets.to_numpy()) for c in map(batch.column, ("a_elements", "a_counts", "b_elements", "b_counts"))]
            found, bits = np.zeros(batch.num_rows), np.zeros((batch.num_rows, 64 * LONGS), bool)
            for k in range(batch.num_rows):
                a, ac, b, bc = (v[o[k] : o[k + 1]] for v, o in cols)
                found[k] = weighted_jaccard(a, ac, b, bc)
                some = b[: bits.shape[1]]
                bits[k, : len(some)] = np.isin(some, a, assume_unique=True)
            longs = np.packbits(bits, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found), *(pa.array(np.ascontiguousarray(longs[:, j])) for j in range(LONGS))], names=names)
        release()

    whole = spread(pairs, known, ["elements", "counts"]).select("a", "b", "a_elements", "a_counts", "b_elements", "b_counts")
    return whole.mapInArrow(run, "a binary, b binary, jaccard double, " + ", ".join(f"{c} long" for c in BITS))


def verify(pairs: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """Of pairs a, b those whose weighted Jaccard is the threshold or more."""
    return compared(pairs, known).filter(F.col("jaccard") >= threshold).select("a", "b")


def fitted(rows: int, each: int = 100_000):
    """Joins the partitions of a small result to as many as its rows are worth; no more tasks than that, where a session has
    thousands of shuffle partitions. Has no effect on large ones."""
    return lambda df: df.coalesce(max(1, -(-rows // each)))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, label: the least node of each node's component; by minima of neighbours and of labels' labels, until none changes."""
    both = scratch.keep(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    fit = fitted(both.count())
    labels = scratch.keep(fit(both.groupBy("a").agg(F.min("b").alias("b"))).select(F.col("a").alias("node"), F.least("a", "b").alias("label")))
    while True:
        near = fit(fit(both.join(labels, both["b"] == labels["node"])).groupBy("a").agg(F.min("label").alias("near")))
        lower = fit(labels.join(near, labels["node"] == near["a"])).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("n"), F.col("label").alias("further"))
        new = scratch.keep(fit(lower.join(jump, lower["label"] == jump["n"], "left")).select("node", F.least("label", F.coalesce("further", "label")).alias("label"), "old"))
        changed = not new.filter("label != old").isEmpty()
        scratch.drop(labels)
        labels = new
        if not changed:
            scratch.drop(both)
            return labels.select("node", "label")


def cluster(df: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, node (the text's digest), class_id, keeper: one row for each row of df.

    class_id is the least doc_id of the texts that links of at least the threshold connect; equal texts are one. keeper says
    whether the row is that one: exactly one text of a class (all of its repeated rows with that id). Texts without words,
    null too, aren't compared: each is its own class and keeper. Null ids count as the greatest; a class of only such has a
    null class_id. All links between texts that share a band count; none is capped.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "near")
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.unhex(F.md5(text_of(text).cast("binary"))).alias("node"), text_of(text).alias("text"))
    signed = scratch.keep(sign(docs))
    labels = _labels(docs, signed, threshold, scratch)
    rows = signed.select("doc_id", "node", "weight").join(labels.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").select("doc_id", "node", "weight", F.coalesce("label", "node").alias("label"))
    least = rows.filter("weight > 0").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "node")).alias("first"))
    out = rows.join(least.withColumnRenamed("label", "l"), F.col("label") == F.col("l"), "left")
    own = F.col("weight") == 0
    keeper = own | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("node") == F.col("first.node")))
    return out.select("doc_id", "node", F.when(own, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"), keeper.alias("keeper"))


def _labels(docs: DataFrame, signed: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """node, label of the texts that are linked to others."""
    texts = signed.filter("weight > 0").groupBy("node").agg(F.min(F.struct("doc_id", "weight", "bands")).alias("x")).select("node", "x.doc_id", "x.weight", F.explode("x.bands").alias("band"))
    shared = texts.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    members = texts.join(shared, "band")
    # one row for each text with its shared buckets; a text in large buckets stands in the middle of its near copies
    nodes = scratch.keep(members.groupBy("node").agg(F.sum("size").alias("centre"), F.first("doc_id").alias("doc_id"), F.first("weight").alias("weight"), F.collect_list("band").alias("bands")))
    wanted = nodes.select(F.col("node").alias("n"), F.col("doc_id").alias("i"))
    # what most texts fail is told without moving them: whether any wanted text has their slot; SLOTS rows at most
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS))
    some = docs.withColumn("slot", slot("node")).join(F.broadcast(wanted.select(slot("n").alias("slot")).distinct()), "slot", "left_semi")
    source = some.join(wanted, (F.col("node") == F.col("n")) & F.col("doc_id").eqNullSafe(F.col("i"))).select("node", "text").dropDuplicates(["node"])
    known = scratch.keep(contents(source))
    apart = F.least("aw", "bw") >= F.lit(threshold) * F.greatest("aw", "bw")
    each = scratch.keep(nodes.select("node", "weight", "centre", F.explode("bands").alias("band")))
    middle = each.groupBy("band").agg(F.max(F.struct("centre", "node", "weight")).alias("m")).select("band", F.col("m.node").alias("b"), F.col("m.weight").alias("bw"))
    pairs = scratch.keep(each.select("band", F.col("node").alias("a"), F.col("weight").alias("aw")).join(middle, "band").filter((F.col("a") != F.col("b")) & apart).select("band", "a", "b"))
    first = scratch.keep(compared(pairs.select("a", "b").distinct(), known))
    edges = first.filter(F.col("jaccard") >= threshold).select("a", "b")
    # how far each text is from its bucket's middle, and what it has of it; unknown where the sizes alone keep them apart
    far = pairs.join(first, ["a", "b"]).select("band", F.col("a").alias("node"), (1 - F.col("jaccard")).alias("far"), *BITS)
    far = far.unionByName(middle.select("band", F.col("b").alias("node"), F.lit(0.0).alias("far")), allowMissingColumns=True)
    labels, most, before = components(edges, scratch), CENTRES, 0
    named = lambda x: x.join(labels.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").withColumn("label", F.coalesce("label", "node")).drop("n")
    x = still_open(named(nodes.select("node", "weight", "bands")), scratch)
    x = x.join(reachable(x, known, scratch), "node").filter(F.col("most") >= F.lit(threshold - 1e-9) * F.col("weight"))
    x = still_open(x, scratch)
    largest = x.agg(F.max(F.array_max(F.col("buckets.size")))).first()[0]
    if largest is None:
        return labels
    # a text's place in each of its buckets: its centres are those with the first places
    place = F.pmod(F.xxhash64("band", "node"), F.lit(1 << 30)) * F.col("size") / float(1 << 30)
    rows = x.select("node", "weight", "most", F.col("buckets.band").alias("bands"), F.explode("buckets").alias("in")).select("*", "in.band", "in.size").drop("in")
    rows = scratch.keep(rows.join(far, ["band", "node"], "left").select("band", "node", "weight", "most", "bands", "far", *BITS, place.alias("place")))
    scratch.drop(each, pairs)
    while True:
        now = named(rows)
        side = lambda k, own=now: own.select("band", *(F.col(c).alias(f"{k}_{c}") for c in ("node", "weight", "most", "bands", "far", *BITS, "place", "label")))
        # links of other texts with one centre at least, none of which was a centre before, each pair in its first common bucket
        # what both can share: what other texts have of one, less the middle's elements that it has and the other lacks
        lacks = lambda k, o: sum((F.bit_count(F.col(f"{k}_{c}").bitwiseAND(F.bitwise_not(f"{o}_{c}"))) for c in BITS), F.lit(0))
        share = F.least(*(F.col(f"{k}_most") - F.coalesce(lacks(k, o), F.lit(0)) for k, o in ("ab", "ba")))
        fits = (F.col("a_label") != F.col("b_label")) & (share >= F.lit((threshold - 1e-9) / (1 + threshold)) * (F.col("a_weight") + F.col("b_weight")))
        fits &= (F.col("a_place") >= before) & ((F.col("a_place") >= most) | (F.col("a_node") < F.col("b_node")))
        fits &= F.array_min(F.array_intersect("a_bands", "b_bands")) == F.col("band")
        # the distance 1 - Jaccard keeps the triangle's inequality
        fits &= ~F.coalesce(F.abs(F.col("a_far") - F.col("b_far")) > 1 - threshold + 1e-9, F.lit(False))
        b = side("b").filter((F.col("b_place") >= before) & (F.col("b_place") < most)).withColumnRenamed("band", "b_band")
        new = scratch.keep(side("a").join(b, (F.col("band") == F.col("b_band")) & fits).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")))
        more = scratch.keep(verify(new, known, threshold))
        if not more.isEmpty():
            edges = scratch.keep(edges.unionByName(more))
            labels = components(edges, scratch)
        if largest <= most:  # all members were centres
            return labels
        before, most = most, most * MORE


def still_open(x: DataFrame, scratch: Scratch) -> DataFrame:
    """x's texts that are in buckets whose members have several labels, with those buckets and their sizes; one row a text.

    x has bands, or such buckets from before.
    """
    kept = [c for c in x.columns if c not in ("bands", "buckets")]
    x = scratch.keep(x.select(*kept, F.col("buckets.band").alias("bands")) if "buckets" in x.columns else x)
    fit = fitted(x.count(), 10_000)
    each = x.select("node", "label", F.explode("bands").alias("band"))
    mixed = each.groupBy("band").agg(F.count("*").alias("size"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("band", "size")
    cut = each.select("node", "band").join(mixed, "band").groupBy("node").agg(F.collect_list(F.struct("band", "size")).alias("buckets"))
    return scratch.keep(fit(x.select(*kept).join(cut, "node")))


def reachable(x: DataFrame, known: DataFrame, scratch: Scratch) -> DataFrame:
    """node, most: the weight of a text's elements that texts of another label have too; no link to one can hold more."""
    inside = known.join(x.select("node", "label"), "node").select("node", "label", F.explode(F.arrays_zip("elements", "counts")).alias("e")).select("node", "label", F.col("e.elements").alias("element"), F.col("e.counts").alias("n"))
    common = inside.groupBy("element").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("element")
    return scratch.keep(inside.join(common, "element").groupBy("node").agg(F.sum("n").alias("most")))


def near_duplicates(df: DataFrame) -> DataFrame:
    """doc_id, class_id: one row for each document."""
    return cluster(df).select("doc_id", "class_id")


def deduplicate(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df's rows less all but one document of each class, with df's columns. Of rows equal in id and text one stays.

    doc_id may be of any type that has an order; only whole numbers keep theirs, others are ordered by their hash.
    """
    i, n, own = fresh(df, "i"), fresh(df, "n"), fresh(df, "node")
    number = F.col(doc_id).cast("long") if df.schema[doc_id].dataType.typeName() in ("byte", "short", "integer", "long") else F.when(F.col(doc_id).isNotNull(), F.xxhash64(doc_id))
    keyed = df.withColumn(own, F.unhex(F.md5(text_of(text).cast("binary"))))
    found = cluster(keyed.select(number.alias("doc_id"), text_of(text).alias("text")))
    keep = Scratch(df.sparkSession, "kept").keep(found.filter("keeper").select(F.col("doc_id").alias(i), F.col("node").alias(n)))
    repeated = not keep.groupBy(i, n).count().filter("count > 1").isEmpty()
    out = keyed.join(keep.distinct() if repeated else keep, (F.col(own) == F.col(n)) & number.eqNullSafe(F.col(i)), "left_semi")
    if repeated:
        out = out.dropDuplicates([doc_id, own])
    return out.drop(own)
