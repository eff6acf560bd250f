"""What the operators of this folder share: text columns, scratch tables, Arrow blocks."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text that one block of a mapInArrow step holds at most, a single longer text apart.
BLOCK_CHARS = 16_000_000


def text_of(column: str | Column) -> Column:
    """The text as a string; null counts as empty."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def fresh(df: DataFrame | list[str], base: str) -> str:
    """A column name that df doesn't have in any case of letters: base, with underscores before it as needed."""
    taken = {c.lower() for c in (df if isinstance(df, list) else df.columns)}
    name = f"__{base}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor and the driver can read: spark.checkpoint.dir; a temporary one where that is unset and all
    runs on one machine, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="veilframe-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found


#: Rows of an Arrow batch: texts are long, and a batch is held several times over, by Spark and by Python.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Makes the session's Arrow batches small enough for long texts, unless it has a smaller size already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def release() -> None:
    """Gives memory that a worker process no longer uses back; it lives on after a task, beside other processes."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Scratch:
    """Tables that one run of an operator writes to the shared folder to cut its lineage.

    `keep(df)` writes and rereads; `drop()` removes the tables named (all, if none is), once nothing reads them any more.
    """

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}", 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for path in [f._scratch_path for f in frames] or [self.root]:
            jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(jpath, True)


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", chars: int = BLOCK_CHARS) -> Iterator[pa.Table]:
    """Joins record batches, or cuts them, to tables of about `chars` bytes of text, in order."""
    held, size = [], 0
    for batch in batches:
        start, lengths = 0, pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        for k, n in enumerate(lengths):
            if size and size + n > chars:
                if k > start:
                    held.append(batch.slice(start, k - start))
                yield pa.Table.from_batches(held)
                held, size, start = [], 0, k
            size += n
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
