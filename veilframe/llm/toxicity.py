"""Toxicity scores from confirmed toxic examples and unlabelled text: non-negative positive-unlabelled learning.

The risk of a classifier over all text is pi * E_p[l(+)] + E_u[l(-)] - pi * E_p[l(-)], with pi the share of toxic documents;
the last two terms estimate the risk over clean text, which can't be negative. Where that estimate falls below zero a step
goes back up its slope (the non-negative correction), so that the fit doesn't go after the positives in the unlabelled set.

A document is the set of pieces of its words: runs of 4, 5, 6 and 8 bytes of its text in lower case, with one blank between
words and none between single letters that stand apart. So a word that no example had is known by its stem or its ending.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import Scratch, fresh, release, text_of

#: Labelled rows the fit takes at most, about, chosen by a hash of the id: confirmed ones, and ones whose label it ignores.
MOST_POSITIVE, MOST_UNLABELLED = 4_000, 8_000
#: Pieces the classifier looks at, at most; candidates that are counted over all documents; examples a piece must occur in.
FEATURES, CANDIDATES, LEAST = 8_192, 16_384, 3
#: Bytes of a piece.
SIZES = (4, 5, 6, 8)
#: A row in FOLDS is held out; of the others, one in TUNING sets the threshold.
FOLDS, TUNING = 5, 4
#: Bytes looked at at once.
CHUNK = 1 << 18
_BITS = 22
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)


def words(text: str | Column) -> Column:
    """The text's runs of letters and digits in lower case, a blank before and after each; single letters in a row are one word."""
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(text_of(text)), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    return F.regexp_replace(plain, r"(?<= \p{L}) (?=\p{L} )", "")


def held_out(doc_id: str | Column) -> Column:
    """Whether crc32(doc_id as text) leaves 0 by FOLDS; false for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets from 0 of an Arrow column of strings without nulls."""
    c = column.cast(pa.large_binary())
    offsets = np.frombuffer(c.buffers()[1], np.int64)[c.offset : c.offset + len(c) + 1]
    data = np.frombuffer(c.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(c) and c.buffers()[2] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


def _eights(data: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """The eight bytes from each position of data[lo:hi] on, as numbers; zeros stand for what is past the end."""
    part = np.zeros(hi - lo + 16, np.uint8)
    held = data[lo : min(hi + 8, len(data))]
    part[: len(held)] = held
    out = np.empty(hi - lo, _U)
    for s in range(8):
        slot = out[s::8]
        slot[:] = np.frombuffer(part, "<u8", len(slot), s)
    return out


def _mask(size: int) -> np.uint64:
    return _U((1 << 8 * size) - 1)


def _parts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of an Arrow column, in runs of rows of about CHUNK bytes; a longer text is alone."""
    data, offsets = _bytes(column)
    row = 0
    while row < len(offsets) - 1:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
        yield data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct pieces of texts, as numbers, and how many of the texts have each; for every CHUNK bytes."""
    for lo in range(0, len(data), CHUNK):
        hi = min(lo + CHUNK, len(data))
        at = np.arange(lo, hi)
        own = np.searchsorted(offsets, at, side="right") - 1
        left, eight = offsets[own + 1] - at, _eights(data, lo, hi)
        found, counts = [], []
        for size in SIZES:
            ok = left >= size
            r, v = own[ok], eight[ok] & _mask(size)
            order = np.lexsort((r, v))
            r, v = r[order], v[order]
            once = np.concatenate([[True], (r[1:] != r[:-1]) | (v[1:] != v[:-1])]) if len(v) else np.zeros(0, bool)
            v = v[once]
            first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, int)
            found.append(v[first])
            counts.append(np.diff(np.append(first, len(v))))
        yield np.concatenate(found), np.concatenate(counts)


@dataclass
class Finder:
    """Finds pieces of a given, sorted set in texts; most others are told apart by a bit each."""

    values: np.ndarray
    bits: np.ndarray = field(init=False, repr=False)
    size: np.ndarray = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.bits = np.zeros(1 << _BITS, bool)
        self.bits[self._slot(self.values)] = True
        self.size = np.zeros(len(self.values), np.int64)
        for n in SIZES:
            self.size[self.values > _mask(n - 1)] = n

    @staticmethod
    def _slot(v: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((v * _ODD) >> _U(64 - _BITS)).astype(np.int64)

    def find(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and numbers, each pair once, sorted."""
        own, n = [np.zeros(0, np.int64)], len(self.values)
        for lo in range(0, len(data) if n else 0, CHUNK):
            hi = min(lo + CHUNK, len(data))
            eight = _eights(data, lo, hi)
            for size in SIZES:
                v = eight & _mask(size)
                at = np.flatnonzero(self.bits[self._slot(v)])
                v = v[at]
                k = np.minimum(np.searchsorted(self.values, v), n - 1)
                ok = (self.values[k] == v) & (self.size[k] == size)
                at, k = at[ok] + lo, k[ok]
                row = np.searchsorted(offsets, at, side="right") - 1
                whole = at + size <= offsets[row + 1]
                own.append(np.unique(row[whole] * n + k[whole]))
        pairs = np.unique(np.concatenate(own))
        return pairs // max(n, 1), pairs % max(n, 1)


@dataclass
class Model:
    """A linear classifier over pieces (sorted) and the logarithm of a text's length."""

    values: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 0.0

    def scores(self, data: np.ndarray, offsets: np.ndarray, finder: Finder | None = None) -> np.ndarray:
        """Scores from 0 to 1 of the texts."""
        rows, numbers = (finder or Finder(self.values)).find(data, offsets)
        sums = np.bincount(rows, self.weights[numbers], len(offsets) - 1) + self.bias + self.slope * length(offsets)
        return 1 / (1 + np.exp(-np.clip(sums, -50, 50)))


def length(offsets: np.ndarray) -> np.ndarray:
    return np.log1p(np.diff(offsets).astype(float))


def _excess(toxic: np.ndarray, n_toxic: int, other: np.ndarray | int, n_other: int) -> np.ndarray:
    """How far, in standard errors, shares among toxic documents are above those among others."""
    a, b = max(n_toxic, 1), max(n_other, 1)
    share = (toxic + other) / (a + b)
    return (toxic / a - other / b) / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / a + 1 / b))


def _chance(candidates: int) -> float:
    """What the best of as many candidates comes to by chance."""
    return float(np.sqrt(2 * np.log(max(candidates, 8))))


def above(z: np.ndarray, least: float, most: int) -> np.ndarray:
    """Numbers of those over least, the greatest ones if they are more than most; sorted."""
    keep = np.flatnonzero(z > least)
    return np.sort(keep[np.argsort(-z[keep], kind="stable")[:most]])


@dataclass
class Examples:
    """Documents as the numbers of their pieces and their lengths' logarithms, less the mean of all."""

    rows: np.ndarray
    numbers: np.ndarray
    size: np.ndarray

    def __len__(self) -> int:
        return len(self.size)

    @staticmethod
    def of(docs: list[np.ndarray], size: np.ndarray | None = None) -> Examples:
        n = np.array([len(d) for d in docs], int)
        return Examples(np.repeat(np.arange(len(docs)), n), np.concatenate([*docs, np.zeros(0, int)]).astype(int), np.zeros(len(docs)) if size is None else size)

    def take(self, which: np.ndarray) -> Examples:
        new = np.cumsum(which) - 1
        ok = which[self.rows]
        return Examples(new[self.rows[ok]], self.numbers[ok], self.size[which])

    def sums(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, w[self.numbers], len(self)) + w[-2] + w[-1] * self.size

    def slope(self, s: np.ndarray, n: int) -> np.ndarray:
        out = np.bincount(self.numbers, s[self.rows], n + 2)
        out[n], out[n + 1] = s.sum(), s @ self.size
        return out


def nnpu(positive: Examples, unlabelled: Examples, prior: float, n: int, steps: int = 800, rate: float = 0.05, decay: float = 1e-5) -> np.ndarray:
    """Weights of n pieces, then bias and slope, under the non-negative risk with the sigmoid loss; by Adam.

    Each step takes all examples. Losses: l(+) = 1 - s, l(-) = s, with s the score.
    """
    w, m, v = np.zeros(n + 2), np.zeros(n + 2), np.zeros(n + 2)
    w[n] = np.log(prior / (1 - prior))
    for t in range(1, steps + 1):
        sp, su = (1 / (1 + np.exp(-np.clip(x.sums(w), -50, 50))) for x in (positive, unlabelled))
        toxic = prior * positive.slope(sp * (1 - sp) / max(len(positive), 1), n)
        clean = unlabelled.slope(su * (1 - su) / max(len(unlabelled), 1), n) - toxic
        g = clean - toxic if su.mean() >= prior * sp.mean() else -clean
        g[:n] += decay * w[:n]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def cut(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The sum from which a document counts as toxic: the one with the greatest recall ** 2 / share found of unlabelled rows,
    which needs no clean labels. The middle between neighbouring sums; 0 for under 20 positives."""
    if len(positive) < 20 or not len(unlabelled):
        return 0.0
    at = np.unique(positive)
    recall = 1 - np.searchsorted(np.sort(positive), at) / len(positive)
    share = 1 - np.searchsorted(np.sort(unlabelled), at) / len(unlabelled)
    best = at[np.argmax(recall**2 / np.maximum(share, 1 / len(unlabelled)))]
    lower = np.concatenate([positive[positive < best], unlabelled[unlabelled < best]])
    return float((best + (lower.max() if len(lower) else best)) / 2)


def piece_counts(texts: DataFrame) -> DataFrame:
    """piece, n: how many rows of a column w have each piece; a text longer than CHUNK counts once for each CHUNK it fills."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch.column("w")):
                for v, n in pieces(*part):
                    yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(n)], names=["piece", "n"])
        release()

    return texts.select("w").mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def document_frequencies(texts: DataFrame, values: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many rows of a column w each of the pieces (sorted) occurs, and the number of rows. Each task sends its counts."""
    shared = texts.sparkSession.sparkContext.broadcast(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n = Finder(shared.value), 0
        sums = np.zeros(len(own.values), np.int64)
        for batch in batches:
            n += batch.num_rows
            for part in _parts(batch.column("w")):
                sums += np.bincount(own.find(*part)[1], minlength=len(sums))
        there = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *there], pa.int32()), pa.array([n, *sums[there]], pa.int64())], names=["k", "n"])
        release()

    got = texts.select("w").mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    k, n = got.column("k").to_numpy(), got.column("n").to_numpy()
    out = np.zeros(len(values), np.int64)
    out[k[k >= 0]] = n[k >= 0]
    return out, int(n[k < 0].sum())


def examples(texts: DataFrame, values: np.ndarray) -> tuple[Examples, np.ndarray]:
    """Rows of w as Examples, and a matrix of their toxic, pool and tune marks; in an order of their own that reruns share."""
    shared = texts.sparkSession.sparkContext.broadcast(values)
    marks = ["toxic", "pool", "tune"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Finder(shared.value)
        for batch in batches:
            at = 0
            for data, offsets in _parts(batch.column("w")):
                rows, numbers = own.find(data, offsets)
                n = len(offsets) - 1
                ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(at, n) for c in marks), pa.array(length(offsets)), lists], names=[*marks, "size", "numbers"])
                at += n
        release()

    got = texts.mapInArrow(run, "toxic boolean, pool boolean, tune boolean, size double, numbers array<int>").toArrow().sort_by([(c, "ascending") for c in (*marks, "size")])
    docs = [np.asarray(x, int) for x in got.column("numbers").to_pylist()]
    # rows of one size and marks come in any order: sort by their pieces
    size = got.column("size").to_numpy()
    flags = np.array([got.column(c).to_numpy(zero_copy_only=False) for c in marks], bool).reshape(3, -1)
    order = sorted(range(len(docs)), key=lambda k: (*flags[:, k].tolist(), size[k], docs[k].tolist()))
    return Examples.of([docs[k] for k in order], size[order]), flags[:, order]


def fit(documents: DataFrame, labels: DataFrame, seed: int = 0) -> Model:
    """Learns from rows that aren't held out: toxic = 1 confirmed, others unlabelled.

    The prior is the toxic share of the labelled rows, within 0.01 and 0.5. The risk is taken over a bounded sample of
    labelled rows, MOST_POSITIVE confirmed ones and MOST_UNLABELLED whose label is ignored; a hash of the id says which. Which
    pieces it looks at comes from counts over all documents. Documents with several labels count as often as they have them;
    null labels and ids don't count. Without any toxic example every score is 0.
    """
    none = Model(np.zeros(0, _U), np.zeros(0), -50.0)
    known = labels.filter(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).select(F.col("doc_id").alias("i"), (F.col("toxic") == 1).alias("toxic"))
    n, toxic = known.agg(F.count("*"), F.sum(F.col("toxic").cast("long"))).first()
    if not toxic:
        return none
    prior = min(max(toxic / n, 0.01), 0.5)
    part = lambda k, share: F.pmod(F.xxhash64(F.lit(seed + k), "i"), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))
    some = known.select("i", (F.col("toxic") & part(1, MOST_POSITIVE / toxic)).alias("toxic"), part(2, MOST_UNLABELLED / n).alias("pool"), part(3, 1 / TUNING).alias("tune")).filter("toxic or pool")
    scratch = Scratch(documents.sparkSession, "toxicity")
    # the sample's ids number MOST_POSITIVE + MOST_UNLABELLED, about
    chosen = scratch.keep(documents.select("doc_id", words("text").alias("w")).join(F.broadcast(some), F.col("doc_id") == F.col("i")).select("toxic", "pool", "tune", "w"))
    try:
        n_pos, n_pool = chosen.agg(F.count_if("toxic"), F.count_if("pool")).first()
        got = piece_counts(chosen.filter("toxic")).filter(F.col("n") >= LEAST).toArrow()
        values, counts = got.column("piece").to_numpy().view(_U), got.column("n").to_numpy()
        order = np.argsort(values)
        values, counts, least = values[order], counts[order], _chance(len(values))
        # those that would be far enough above if no other document had them
        keep = np.flatnonzero(_excess(counts, n_pos, 0, n_pool) > least)
        values, counts = values[keep], counts[keep]
        keep = above(_excess(counts, n_pos, document_frequencies(chosen.filter("pool"), values)[0], n_pool), least, CANDIDATES)
        values, counts = values[keep], counts[keep]
        values = values[above(_excess(counts, n_pos, *document_frequencies(documents.select(words("text").alias("w")), values)), least, FEATURES)]
        if not len(values):
            return none
        docs, (confirmed, pool, tune) = examples(chosen, values)
    finally:
        scratch.drop()
    mean = docs.size[pool].mean() if pool.any() else 0.0
    docs.size = docs.size - mean
    if not pool.any():
        pool = confirmed
    w = nnpu(docs.take(confirmed & ~tune), docs.take(pool & ~tune), prior, len(values))
    threshold = cut(docs.take(confirmed & tune).sums(w), docs.take(pool & tune).sums(w))
    w = nnpu(docs.take(confirmed), docs.take(pool), prior, len(values))
    return Model(values, w[:-2], float(w[-2] - w[-1] * mean - threshold), float(w[-1]))


def score(documents: DataFrame, model: Model, keep: list[str] | None = None, text: str = "text", score: str = "score", predicted: str = "predicted") -> DataFrame:
    """Adds the score and the prediction (1 from 0.5 on) to the columns kept (all, if None; a column with those names is replaced).

    Null and empty texts have a score too, that of no words. Rows are on their own: no shuffle.
    """
    outs = [score, predicted]
    cols = [c for c in (documents.columns if keep is None else keep) if c.lower() not in [o.lower() for o in outs]]
    schema = documents.select(*cols).schema.add(score, "double").add(predicted, "integer")
    shared = documents.sparkSession.sparkContext.broadcast(model)  # FEATURES pieces at most
    w = fresh(documents, "w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        finder = Finder(own.values)
        for batch in batches:
            s = np.concatenate([np.zeros(0), *(own.scores(*part, finder) for part in _parts(batch.column(w)))])
            data = [batch.column(c) for c in cols] + [pa.array(s), pa.array((s >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(data, names=[*cols, *outs])
        release()

    return documents.select(*cols, words(text).alias(w)).mapInArrow(run, schema)


def judge(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each document."""
    scored = score(documents, fit(documents, labels), ["doc_id"])
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def clean(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that aren't predicted toxic, with their own columns, whatever those are called."""
    outs = [fresh(documents, "score"), fresh(documents, "predicted")]
    return score(documents, fit(documents, labels), None, "text", *outs).filter(F.col(outs[1]) == 0).select(*documents.columns)
