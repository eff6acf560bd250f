"""All queries over the driver's tables and, where it can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veilframe.plans import box_queries, manifest_queries, match_queries, raster_queries, text_queries

Query = Callable[[SparkSession, str], DataFrame]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which template is each page? Hashes, costs, assignment, confidence."""
    return match_queries.assign_report(spark, sf_dir)


def whole_counts(sql: str) -> str:
    """SQL whose count_if() gives a BIGINT, as Spark's does."""
    out, at = [], 0
    while (k := sql.find("count_if(", at)) >= 0:
        depth, end = 0, k + 8
        while True:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
            if not depth:
                break
        out += [sql[at:k], "CAST(", sql[k:end], " AS BIGINT)"]
        at = end
    return "".join([*out, sql[at:]])


def _all() -> list[tuple[Query, str | None]]:
    return [x for m in (manifest_queries, box_queries, match_queries, text_queries, raster_queries) for x in m.QUERIES]


def queries() -> dict[str, Query]:
    return {f.__name__: f for f, _ in _all()}


def oracle_sql() -> dict[str, str]:
    return {f.__name__: whole_counts(sql) for f, sql in _all() if sql}
