"""Token ids in seekable zstandard files.

A file is a run of independent zstandard frames, one for each document (several for a very long one), then a skippable
frame with the documents' index, then a skippable frame with the seek table in zstandard's seekable format: for each frame
its compressed size, size and the low 32 bits of the XXH64 of its contents. A reader takes the two tables from the file's
end and decompresses only the frames of the documents it wants.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilframe.llm.common import Scratch, blocks, release, text_of
from veilframe.llm.trie_bpe import LibraryEncoder, encoder

# Fixed values of the zstandard seekable format.
SKIPPABLE, SEEKABLE, DOCUMENTS = 0x184D2A5E, 0x8F92EAB1, 0x184D2A50
CHECKSUMS = 0x80
#: Ids in one frame at most; a longer document takes several frames.
FRAME_IDS = 1 << 20
_INDEX = np.dtype([("id", "<i8"), ("null", "u1"), ("frames", "<u4"), ("ids", "<u8")])


class StoreWriter:
    """Writes documents' ids to one open binary file. width: bytes of an id, 2 or 4."""

    def __init__(self, out: BinaryIO, width: int = 4, level: int = 3):
        if width not in (2, 4):
            raise ValueError("an id takes 2 or 4 bytes")
        self.out, self.width, self.pack = out, width, zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int, int]] = []
        self.index: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.width == 2 and len(ids) and int(ids.max()) > 0xFFFF:
            raise ValueError("an id is too large for 2 bytes")
        data, before = ids.astype(f"<u{self.width}").tobytes(), len(self.frames)
        step = FRAME_IDS * self.width
        for k in range(0, max(1, len(data)), step):
            part = data[k : k + step]
            packed = self.pack.compress(part)
            self.out.write(packed)
            self.frames.append((len(packed), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
        self.index.append((doc_id or 0, doc_id is None, len(self.frames) - before, len(ids)))

    def close(self) -> None:
        body = struct.pack("<4sBI", b"TOKS", self.width, len(self.index)) + np.array(self.index, _INDEX).tobytes()
        self.out.write(struct.pack("<II", DOCUMENTS, len(body)) + body)
        table = np.array(self.frames, "<u4").tobytes() + struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


class StoreReader:
    """Reads documents of one file by their place in it; only their frames are decompressed, and checked."""

    def __init__(self, source, size: int):
        self.source, self.unpack = source, zstandard.ZstdDecompressor()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or not flags & CHECKSUMS:
            raise ValueError("no seek table with checksums at the file's end")
        start = size - 9 - 12 * n
        if struct.unpack("<II", self._at(start - 8, 8)) != (SKIPPABLE, 12 * n + 9):
            raise ValueError("the seek table's frame is damaged")
        self.table = np.frombuffer(self._at(start, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        kind, length = struct.unpack("<II", self._at(int(self.at[-1]), 8))
        body = self._at(int(self.at[-1]) + 8, length)
        tag, self.width, docs = struct.unpack("<4sBI", body[:9])
        if kind != DOCUMENTS or tag != b"TOKS":
            raise ValueError("no index of documents before the seek table")
        self.index = np.frombuffer(body, _INDEX, docs, 9)
        self.first = np.concatenate([[0], np.cumsum(self.index["frames"].astype(np.int64))])
        self.decompressed = 0

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def __len__(self) -> int:
        return len(self.index)

    def doc_id(self, k: int) -> int | None:
        return None if self.index[k]["null"] else int(self.index[k]["id"])

    def ids(self, k: int) -> np.ndarray:
        lo, hi = int(self.first[k]), int(self.first[k + 1])
        data, at = self._at(int(self.at[lo]), int(self.at[hi] - self.at[lo])), 0
        out = []
        for packed, size, check in self.table[lo:hi].tolist():
            part = self.unpack.decompress(data[at : at + packed], max_output_size=size) if size else b""
            if len(part) != size or xxhash.xxh64_intdigest(part) & 0xFFFFFFFF != check:
                raise ValueError(f"document {k}: a frame's checksum is wrong")
            out.append(part)
            at += packed
            self.decompressed += 1
        return np.frombuffer(b"".join(out), f"<u{self.width}").astype(np.uint32)


def _open(path: str):
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


def write(df: DataFrame, folder: str, tokenizer: str, scratch: Scratch, end_id: int | None = 1, width: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes df's documents as seekable files in ascending id order; returns their index.

    Index: part (files ascend by it), file, doc_no (place in the file), doc_id, n_ids. folder must be one that all executors
    reach, by any URI that pyarrow.fs knows. Null ids come first; rows of equal ids are ordered by text, all are kept. Null
    text counts as empty: its ids are the end id alone. A task that is run again writes another file, and the index names
    only the files of tasks whose results were committed. One shuffle, by ranges of ids.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc()]
    ranged = rows.repartitionByRange(order[0]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, own, store = TaskContext.get(), encoder(tokenizer, LibraryEncoder), None
        path, n = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.zst", 0
        end = np.array([] if end_id is None else [end_id], np.uint32)
        for table in blocks(batches, "text", 3_000_000):
            if store is None:
                fs, at = _open(path)
                fs.create_dir(at.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(at, compression=None)
                store = StoreWriter(out, width)
            names, sizes = table.column("doc_id").to_pylist(), []
            for i, ids in zip(names, own.encode_ids(table.column("text").to_pylist()), strict=True):
                full = np.concatenate([np.frombuffer(ids, np.uint32), end])
                store.add(i, full)
                sizes.append(len(full))
            k = len(names)
            yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()] * k, pa.int32()), pa.array([path] * k), pa.array(range(n, n + k), pa.int64()), pa.array(names, pa.int64()), pa.array(sizes, pa.int64())], names=["part", "file", "doc_no", "doc_id", "n_ids"])
            n += k
        if store is not None:
            store.close()
            out.close()
        release()  # the encoder's cache of words is bounded and serves the next task

    return scratch.keep(ranged.mapInArrow(run, "part int, file string, doc_no long, doc_id long, n_ids long"))


def read(index: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Reads documents from the files an index names: all, or those whose doc_id is in wanted; doc_id, start, ids BINARY.

    ids are little-endian unsigned 32-bit integers, start the ids of all documents before it in the whole store. An empty
    index gives no rows.
    """
    files = index.groupBy("part", "file").agg(F.sum("n_ids").alias("n"), F.count("*").alias("docs"))
    # one row a file: sums over files, not over documents
    starts = files.withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n", "docs")
    if wanted is None:
        todo = starts.withColumn("docs", F.lit(None).cast("array<long>"))
    else:
        hits = index.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
        # a row for every 1000 documents of a file at most
        todo = hits.groupBy("part", "file", F.floor(F.col("doc_no") / 1000).alias("k")).agg(F.sort_array(F.collect_list("doc_no")).alias("docs")).join(starts, ["part", "file"]).select("part", "file", "base", "docs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, at = _open(row["file"])
                with fs.open_input_file(at) as source:
                    store = StoreReader(source, source.size())
                    before = row["base"] + np.concatenate([[0], np.cumsum(store.index["ids"].astype(np.int64))])
                    ks = range(len(store)) if row["docs"] is None else row["docs"]
                    for lo in range(0, len(ks), 500):
                        part = list(ks[lo : lo + 500])
                        yield pa.RecordBatch.from_arrays([pa.array([store.doc_id(k) for k in part], pa.int64()), pa.array(before[part], pa.int64()), pa.array([store.ids(k).tobytes() for k in part], pa.binary())], names=["doc_id", "start", "ids"])

    return todo.select("file", "base", "docs").repartition(_slots(index.sparkSession)).mapInArrow(run, "doc_id long, start long, ids binary")


def _slots(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def round_trip(df: DataFrame, tokenizer: str) -> DataFrame:
    """Writes documents to the shared folder, reads the files back: doc_id, start, n_tokens, ids_crc32 from what was read."""
    scratch = Scratch(df.sparkSession, "tokens")
    index = write(df, f"{scratch.root}/store", tokenizer, scratch, width=2)
    return read(index).select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
