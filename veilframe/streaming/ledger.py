"""The ledger as a stream: new result files are picked up, and what remains to be done follows from what has been done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def follow(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str) -> StreamingQuery:
    """Appends the rows of new Parquet files in a folder to a target, once each; ends when all that is there is taken."""
    rows = spark.readStream.schema(schema).parquet(folder).withColumn("taken_at", F.current_timestamp())
    return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def rates(events: DataFrame, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Items by status in windows of time, from a stream or table with ended and status; rows later than `late` are left out."""
    return events.withWatermark("ended", late).groupBy(F.window("ended", window), "status").agg(F.count("*").alias("n"))


def remaining(manifest: DataFrame, ledger: DataFrame, id_: str = "subject_id") -> DataFrame:
    """Manifest rows of ids without a success yet."""
    return manifest.join(ledger.filter("status = 'success'").select(id_).distinct(), id_, "left_anti")
