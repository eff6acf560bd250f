"""The append-only status ledger: one row for each work item and run, and what is asked of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATUSES = ("success", "failed", "timeout", "worker_exception")


def latest(df: DataFrame, id_: str = "subject_id", pos: str = "ingest_pos") -> DataFrame:
    """The last row of each id. max_by aggregates in the map tasks, so a frequent id is no burden."""
    cols = [c for c in df.columns if c != id_]
    return df.groupBy(id_).agg(F.max_by(F.struct(*cols), pos).alias("x")).select(id_, "x.*").select(*df.columns)


def with_status(df: DataFrame, status: str = "success") -> DataFrame:
    return df.filter(F.col("status") == status)


def without_status(df: DataFrame, status: str = "success") -> DataFrame:
    """Rows of another status, a missing one too."""
    return df.filter(~F.col("status").eqNullSafe(status))


def frequencies(df: DataFrame, column: str, with_null: bool = False) -> DataFrame:
    """column, n: most frequent first, then by value."""
    x = df if with_null else df.filter(F.col(column).isNotNull())
    return x.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def time_stats(df: DataFrame, over: float = 100.0, secs: str = "secs") -> DataFrame:
    """Mean over the rows with a time, and how many took longer than `over`."""
    return df.agg(F.round(F.avg(secs), 6).alias("mean_secs"), F.count_if(F.col(secs) > over).alias("n_over"), F.count(secs).alias("n_timed"))


def slowest(df: DataFrame, n: int = 5, secs: str = "secs", tie: str = "ingest_pos") -> DataFrame:
    return df.orderBy(F.desc_nulls_last(secs), tie).limit(n)


def distinct_ids(df: DataFrame, id_: str = "subject_id") -> DataFrame:
    """Distinct ids in all rows and by outcome."""
    ok = F.col("status").eqNullSafe("success")
    return df.agg(F.countDistinct(id_).alias("n_ids"), F.countDistinct(F.when(ok, F.col(id_))).alias("n_success"), F.countDistinct(F.when(~ok, F.col(id_))).alias("n_other"))


def stack(frames: list[DataFrame]) -> DataFrame:
    """All rows of several ledgers, whose columns may differ."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def batches_to_successes(df: DataFrame) -> DataFrame:
    """Distinct rows that succeeded, whatever batch wrote them."""
    return with_status(df).drop("batch_id").dropDuplicates()


def speed_up(df: DataFrame, workers: str = "workers", secs: str = "secs") -> DataFrame:
    """speed_up against the run with the fewest workers, and efficiency in percent."""
    # a handful of runs
    first = F.first(secs).over(Window.partitionBy(F.lit(0)).orderBy(workers))
    return df.withColumn("speed_up", first / F.col(secs)).withColumn("efficiency", 100 * F.col("speed_up") / F.col(workers))


def warning_texts(pages: DataFrame) -> DataFrame:
    """subject_id, warning_ordering, warning_censoring: a subject's outcome in words, from its pages.

    Three blanks stand after the colon, as the ledgers' readers expect.
    """
    warned = F.col("matched_template").isNull() | (1 - F.col("ocr_similarity") > 0.3)
    k, n, large = F.count_if(warned), F.count("*"), F.count_if(F.col("large_boxes"))
    of = lambda a, b: F.concat(F.lit("   "), a.cast("string"), F.lit("/"), b.cast("string"))
    x = pages.groupBy("subject_id").agg(F.bool_or("passed_1").alias("p1"), F.bool_or("passed_2").alias("p2"), k.alias("k"), n.alias("n"), large.alias("large"))
    order = F.when(F.col("p1"), F.lit("First stage")).when(F.col("p2"), F.lit("Second stage")).otherwise(F.concat(F.lit("OCR stage, pages with warning:"), of(F.col("k"), F.col("n"))))
    censor = F.when(F.col("large") > 0, F.concat(F.lit("pages censored with large boxes:"), of(F.col("large"), F.col("n")))).otherwise(F.lit("No warning"))
    return x.select("subject_id", order.alias("warning_ordering"), censor.alias("warning_censoring"))


def page_outcome_text(pages: DataFrame, key: str = "subject_id") -> DataFrame:
    """key, text: a subject's page outcomes as one JSON array, in order of page_no; a subject's pages are a few dozen."""
    rest = [c for c in pages.columns if c != key]
    items = F.array_sort(F.collect_list(F.struct("page_no", F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias("j"))))
    return pages.groupBy(key).agg(items.alias("x")).select(key, F.concat(F.lit("["), F.concat_ws(",", F.transform("x", lambda v: v["j"])), F.lit("]")).alias("text"))


def status_column(error: Column, timed_out: Column) -> Column:
    """One of STATUSES from an error's type and a timeout flag."""
    return F.when(timed_out, F.lit("timeout")).when(error.isNull(), F.lit("success")).when(error == "WorkerError", F.lit("worker_exception")).otherwise(F.lit("failed"))
