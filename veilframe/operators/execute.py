"""Work per subject with its outcome in the ledger: every item gives rows, whatever happens to it."""

from __future__ import annotations

import time
import traceback
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What the ledger adds to an item's rows.
OUTCOME = "status string, secs double, error_type string, error_message string, error_traceback string"


class Deadline:
    """Time left for an item; work checks it between its steps, as a running step can't be stopped from within."""

    def __init__(self, seconds: float):
        self.end = time.monotonic() + seconds

    def check(self) -> None:
        if time.monotonic() > self.end:
            raise TimeoutError("the item's time is over")


class WorkerError(RuntimeError):
    """Raised by work whose process can't go on."""


def run_items(df: DataFrame, work: Callable[[pd.DataFrame, Deadline], pd.DataFrame], key: str = "subject_id", seconds: float = 300.0) -> DataFrame:
    """work's result for each key's rows, which has df's columns, with status, secs and the error.

    An exception or a passed deadline gives the item's own rows back with the status failed, timeout or worker_exception, so
    that no item is lost; a result that isn't df's columns counts as failed. Spark runs a task again where an executor is lost.
    """
    cols = df.columns
    schema = T.StructType(df.schema.fields + T.StructType.fromDDL(OUTCOME).fields)

    def one(group: pd.DataFrame) -> pd.DataFrame:
        start = time.monotonic()
        try:
            out = work(group, Deadline(seconds))
            if time.monotonic() - start > seconds:
                raise TimeoutError("the item's time is over")
            return out[cols].assign(status="success", secs=time.monotonic() - start, error_type=None, error_message=None, error_traceback=None)
        except Exception as e:  # noqa: BLE001 the ledger records whatever happened
            status = "timeout" if isinstance(e, TimeoutError) else "worker_exception" if isinstance(e, WorkerError) else "failed"
            return group.assign(status=status, secs=float("nan"), error_type=type(e).__name__, error_message=str(e), error_traceback=traceback.format_exc())

    out = df.groupBy(key).applyInPandas(one, schema)
    return out.withColumn("secs", F.when(~F.isnan("secs"), F.col("secs")))


def retry(df: DataFrame, work: Callable, key: str = "subject_id", seconds: float = 300.0, times: int = 2, path: str | None = None) -> DataFrame:
    """run_items again for items that timed out or lost their worker; the last outcome of each counts, with its attempt."""
    spark, todo, done = df.sparkSession, df, None
    for k in range(times + 1):
        ran = run_items(todo, work, key, seconds).withColumn("attempt", F.lit(k))
        if path:
            ran.write.mode("overwrite").parquet(f"{path}/attempt={k}x")
            ran = spark.read.parquet(f"{path}/attempt={k}x").withColumn("attempt", F.lit(k))
        again = F.col("status").isin("timeout", "worker_exception")
        final = ran if k == times else ran.filter(~again)
        done = final if done is None else done.unionByName(final)
        if k < times:
            todo = ran.filter(again).select(*df.columns)
            if todo.isEmpty():
                break
    return done


def stage_times(events: DataFrame, key: str = "subject_id") -> DataFrame:
    """secs per item and stage from rows of key, stage, started, ended (timestamps)."""
    return events.select(key, "stage", (F.unix_micros("ended") - F.unix_micros("started")).alias("us")).groupBy(key, "stage").agg((F.sum("us") / 1e6).alias("secs"))
