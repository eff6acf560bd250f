"""Token counts from a table of distinct pre-tokens, without any ids.

A first pass finds the distinct pre-tokens of all texts and how often each occurs; each is encoded once, for its number of
pieces. A second pass makes each document's pre-token frequencies and joins them to that table: frequent pre-tokens (at most
HOT of them, as each has more than 1/HOT of all occurrences) by a broadcast, so that no join key is frequent, all others by
a shuffled join. The products' sums are the counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from veilframe.llm.common import Scratch, blocks, release, text_of

#: Pre-tokens that may be broadcast, at most: those with more than 1/HOT of all occurrences.
HOT = 1 << 20
#: A text between runs of white space, with the one space that the pre-tokenizer's patterns may take in before it; or such
#: a run. The library's patterns never match across these.
CHUNK = re.compile(r" ?[^\s]+|\s+(?![^\s])|\s+")
#: Characters that Python's \s has and the library's doesn't; texts with them are cut by the library.
NOT_SPACE = re.compile("[\x1c-\x1f]")
PUNCTUATION = frozenset(".,;:!?")
#: Pieces longer than this are counted where they stand, not joined: a key of a megabyte helps nobody.
LONG = 4096

_OWN: dict[str, tuple] = {}


class Counter_:
    """Cuts texts into pre-tokens and counts a pre-token's pieces, for one tokenizer file."""

    def __init__(self, path: str):
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.cost: dict[str, int] = {}
        self.rare: dict[str, tuple[int, tuple[str, ...]]] = {}

    def chunks(self, text: str) -> list[str]:
        """Chunks of a text that holds no special token."""
        return CHUNK.findall(text) if not NOT_SPACE.search(text) else [w for w in self.pretokens(text)]

    def pretokens(self, chunk: str) -> list[str]:
        return [chunk[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(chunk)]

    def cut_text(self, text: str) -> tuple[list[str], int]:
        """A text's chunks, and the number of special tokens in it."""
        parts, n = [text], 0
        for content in self.special:
            if content in text:
                cut = [p.split(content) for p in parts]
                n += sum(len(c) - 1 for c in cut)
                parts = [x for c in cut for x in c]
        return (self.chunks(text), 0) if not n else (list(chain.from_iterable(map(self.chunks, parts))), n)

    def split(self, chunk: str) -> tuple[str, ...]:
        """The pre-tokens of a chunk."""
        body = chunk[1:] if chunk[0] == " " else chunk
        if body.isascii():
            if body.isalpha():
                return (chunk,)
            if body[-1:] in PUNCTUATION and body[:-1].isalpha():
                return (chunk[:-1], chunk[-1])
        return tuple(self.pretokens(chunk))

    def frequencies(self, chunks: Counter) -> Counter:
        """Frequencies of the pre-tokens of chunks."""
        out: Counter = Counter()
        for c, n in chunks.items():
            for p in self.split(c):
                out[p] += n
        return out

    def weigh(self, chunk: str, known: dict[str, int]) -> tuple[int, tuple[str, ...]]:
        """Pieces of a chunk's known pre-tokens, and the others."""
        if (found := self.rare.get(chunk)) is not None:
            return found
        x, others = 0, []
        for p in self.split(chunk):
            if p in known:
                x += known[p]
            elif len(p) > LONG:
                x += self.pieces([p])[0]
            else:
                others.append(p)
        if others:
            if len(self.rare) > 300_000:
                self.rare.clear()
            self.rare[chunk] = x, tuple(others)
        else:
            if len(self.cost) > 300_000:
                self.cost.clear()
            self.cost[chunk] = x
        return x, tuple(others)

    def pieces(self, pretokens: list[str]) -> list[int]:
        """Pieces of each pre-token."""
        out = []
        for k in range(0, len(pretokens), 20_000):
            out += [len(e.ids) for e in self.tok.encode_batch(pretokens[k : k + 20_000], add_special_tokens=False)]
        return out


def _own(path: str) -> Counter_:
    if path not in _OWN:
        _OWN[path] = Counter_(path)
    return _OWN[path]


def vocabulary(texts: DataFrame, tokenizer: str) -> DataFrame:
    """pretoken, n: the distinct pre-tokens of a text column `text` and their occurrences; summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = _own(tokenizer), Counter()

        def flush() -> pa.RecordBatch:
            found = own.frequencies(seen)
            keys = [k for k in found if len(k) <= LONG]
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([found[k] for k in keys], pa.int64())], names=["pretoken", "n"])

        for table in blocks(batches):
            for t in table.column("text").to_pylist():
                seen.update(own.cut_text(t)[0])
            if len(seen) > 500_000:
                yield flush()
                seen.clear()
        if seen:
            yield flush()

    return texts.mapInArrow(run, "pretoken string, n long").groupBy("pretoken").agg(F.sum("n").alias("n"))


def with_pieces(words: DataFrame, tokenizer: str) -> DataFrame:
    """Adds pieces, the tokens of each distinct pre-token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _own(tokenizer)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("pretoken"), batch.column("n"), pa.array(own.pieces(batch.column("pretoken").to_pylist()), pa.int32())], names=["pretoken", "n", "pieces"])

    return words.mapInArrow(run, "pretoken string, n long, pieces int")


def count(df: DataFrame, tokenizer: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit): one row for each row of df.

    The counts are those of the tokenizers library for a byte-level BPE file, without added begin or end tokens; special
    tokens inside a text count one. Null text counts as empty, with no tokens. Null and repeated ids are kept, a row each.
    """
    spark, scratch = df.sparkSession, Scratch(df.sparkSession, "counts")
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    words = scratch.keep(with_pieces(vocabulary(docs.select("text"), tokenizer), tokenizer))
    total = words.agg(F.sum("n")).first()[0] or 0
    # more than total / HOT occurrences each: HOT rows at most
    often = words.filter(F.col("n") > max(total / HOT, 100)).select("pretoken", "pieces").toPandas()
    hot = spark.sparkContext.broadcast(dict(zip(often["pretoken"], often["pieces"].tolist(), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known, task = _own(tokenizer), hot.value, TaskContext.get().partitionId() << 40
        own.cost, own.rare = {}, {}  # they hold for one table of frequent pre-tokens
        row = 0
        for table in blocks(batches, "text", 4_000_000):
            keys, ids, sizes, words, freqs, sums = [], [], [], [], [], []
            for i, t in zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True):
                chunks, n = own.cut_text(t)
                key = task | row
                row += 1
                costs = list(map(own.cost.get, chunks))
                left: Counter = Counter()
                for c in [c for c, x in zip(chunks, costs, strict=True) if x is None] if None in costs else ():
                    if (x := own.cost.get(c)) is None:
                        x, others = own.weigh(c, known)
                        left.update(others)
                    n += x
                n += sum(x for x in costs if x is not None)
                for p, k in left.items():
                    keys.append(key), ids.append(None), sizes.append(None), words.append(p), freqs.append(k), sums.append(0)
                # the document's own row has a key that is no pre-token
                keys.append(key), ids.append(i), sizes.append(len(t.encode())), words.append(f"\0{key} "), freqs.append(0), sums.append(n)
            data = [pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(words, pa.string()), pa.array(freqs, pa.int64()), pa.array(sums, pa.int64())]
            yield from pa.Table.from_arrays(data, names=["key", "doc_id", "n_bytes", "pretoken", "freq", "n"]).to_batches(max_chunksize=50_000)
        own.cost, own.rare = {}, {}
        release()

    rare = words.filter(F.col("n") <= max(total / HOT, 100)).select("pretoken", "pieces")
    rows = docs.mapInArrow(run, "key long, doc_id long, n_bytes long, pretoken string, freq long, n long")
    joined = rows.join(rare, "pretoken", "left")
    tokens = F.sum(F.col("n") + F.col("freq") * F.coalesce("pieces", F.lit(0)))
    sums = joined.groupBy("key").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), tokens.alias("n_tokens"))
    return sums.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
