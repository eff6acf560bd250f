"""Stand-ins for manifests, ledgers, boxes and so on, made from the driver's tables by arithmetic on their keys.

Each is one SQL text that Spark and DuckDB read alike; {name} stands for a driver table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

MANIFEST = """
SELECT event_id AS ingest_pos,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'S' || user_id END AS subject_id,
  CASE WHEN event_id % 89 = 0 THEN NULL
       WHEN event_id % 101 = 0 THEN 'shared_' || (event_id % 7) || '.tif'
       ELSE 'obj_' || user_id || '_' || (event_id % 5)
            || CASE event_id % 3 WHEN 0 THEN '.tif' WHEN 1 THEN '.pdf' ELSE '' END END AS object_name
FROM {events}"""
LISTING = """
SELECT 'obj_' || u.user_id || '_' || k.k || CASE WHEN (u.user_id + k.k) % 2 = 0 THEN '.pdf' ELSE '.tif.pdf' END AS path
FROM (SELECT DISTINCT user_id FROM {events} WHERE user_id % 10 < 9) u
CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5)) AS k(k)
WHERE (u.user_id + k.k) % 4 <> 0"""
LEDGER = """
SELECT o_orderkey AS ingest_pos, 'S' || (o_custkey % 500) AS subject_id,
  CASE WHEN o_orderstatus = 'F' AND o_custkey % 7 < 2 AND o_custkey % 500 % 3 = 0 THEN 'success' WHEN o_orderstatus = 'P' THEN 'timeout' ELSE 'failed' END AS status,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE round(o_totalprice / 1000, 3) END AS secs
FROM {orders}"""
BOX = """
SELECT CAST(floor(p_partkey / 10) AS BIGINT) AS page_no, p_partkey % 10 AS pos,
  CASE WHEN p_partkey % 10 < 3 THEN 'censor' WHEN p_partkey % 10 < 7 THEN 'censor-close' ELSE 'roi' END AS label,
  p_partkey % 4 = 0 AS is_partial,
  CASE WHEN p_partkey % 10 < 3 THEN (p_partkey * 37) % 300 ELSE (p_partkey * 53) % 600 END AS xtl,
  CASE WHEN p_partkey % 10 < 3 THEN (p_partkey * 41) % 300 ELSE (p_partkey * 59) % 600 END AS ytl,
  CASE WHEN p_partkey % 10 < 3 THEN 500 + p_size * 4 ELSE 20 + p_size * 3 END AS w,
  CASE WHEN p_partkey % 10 < 3 THEN 450 + (p_partkey * 11) % 200 ELSE 20 + (p_partkey * 13) % 120 END AS h
FROM {part}"""
PAGEHASH = """
SELECT CAST(floor(vec_id / 6) AS BIGINT) AS subject_id, vec_id % 6 AS k, embedding
FROM {embeddings} WHERE vec_id < 6 * (SELECT CAST(floor(count(*) / 6) AS BIGINT) FROM {embeddings})"""
FILES = """
SELECT CAST(floor(c_custkey / 4) AS BIGINT) AS subject_id, 'f_' || c_custkey || '.pdf' AS object_name,
  CASE WHEN CAST(floor(c_custkey / 4) AS BIGINT) % 17 = 0 THEN CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE 0 END WHEN c_custkey % 11 = 0 THEN 0 WHEN c_custkey % 5 = 0 THEN 3 + c_custkey % 4 ELSE 1 END AS n_pages,
  1 + CAST(floor(c_custkey / 4) AS BIGINT) % 13 AS questionnaire
FROM {customer}"""
OUTCOME = """
SELECT CAST(floor(o_orderkey / 5) AS BIGINT) AS subject_id, 1 + o_orderkey % 5 AS page_no,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 1 + o_orderkey % 4 END AS matched_template,
  CAST(floor(o_orderkey / 5) AS BIGINT) % 3 = 0 AS passed_1,
  CAST(floor(o_orderkey / 5) AS BIGINT) % 3 = 1 AS passed_2,
  CAST((o_orderkey * 17) % 100 AS DOUBLE) / 100 AS ocr_similarity,
  o_orderkey % 7 = 0 AS large_boxes,
  CASE WHEN o_orderkey % 6 = 0 THEN 'N' ELSE 'P' END AS page_type
FROM {orders}"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A stand-in as a DataFrame."""
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in set(re.findall(r"\{(\w+)\}", sql))})


def plain(sql: str) -> str:
    """A stand-in's text over the driver's own views."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def with_views(sql: str, **views: str) -> str:
    """SQL with common table expressions for the stand-ins named."""
    return "WITH " + ", ".join(f"{k} AS ({plain(v)})" for k, v in views.items()) + sql
