"""Queries over texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.operators import text
from veilframe.plans import proxies as P

_NORM = r"trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}_\s.,:;()/%-]', ' ', 'g'), '\s+', ' ', 'g'))"
_PAIRS = f"""WITH d AS (SELECT doc_id, list_distinct(list_filter(string_split({_NORM}, ' '), lambda t: t <> '')) AS t FROM documents), b AS (SELECT item_id, list_distinct(list_filter(string_split({_NORM}, ' '), lambda t: t <> '')) AS t FROM benchmark),
  x AS (SELECT doc_id, len(t) AS na, unnest(t) AS token FROM d), y AS (SELECT item_id, len(t) AS nb, unnest(t) AS token FROM b), j AS (SELECT doc_id, item_id, na, nb, count(*) AS n FROM x JOIN y USING (token) GROUP BY ALL)"""


def _pairs(spark, sf_dir) -> DataFrame:
    return text.overlap_pairs(P.table(spark, sf_dir, "documents"), P.table(spark, sf_dir, "benchmark"), "doc_id", "item_id")


def text_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.table(spark, sf_dir, "documents").select("doc_id", text.normalise(F.col("text")).alias("text"))


def text_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("doc_id", "item_id", F.round(text.jaccard(F.col("both"), F.col("na"), F.col("nb")), 6).alias("jaccard"))


def text_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("doc_id", "item_id", F.round(text.containment(F.col("both"), F.col("na"), F.col("nb")), 6).alias("containment"))


def text_sequence_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = P.table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("a"))
    other = b.select((F.col("item_id") - 1).alias("item_id"), F.col("a").alias("b"))
    return b.join(other, "item_id").select("item_id", F.round(text.sequence_ratio(F.col("a"), F.col("b")), 6).alias("ratio"))


def text_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = P.table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("a"))
    other = b.select((F.col("item_id") - 1).alias("item_id"), F.col("a").alias("b"))
    return b.join(other, "item_id").select("item_id", text.compare(F.col("a"), F.col("b")).alias("c")).select("item_id", "c.na", "c.nb", F.round("c.jaccard", 6).alias("jaccard"), F.round("c.sequence", 6).alias("sequence"))


def numeric_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.table(spark, sf_dir, "documents").select("doc_id", text.numeric_target(F.col("text")).alias("target"))


def _tokens(spark, sf_dir) -> DataFrame:
    k = F.col("p_partkey")
    words = F.when(k % 10 == 0, F.lpad((k % 1000000).cast("string"), 6, "1")).when(k % 10 < 4, (k % 10).cast("string")).when(k % 10 == 4, F.lpad(k.cast("string"), 7, "2")).when(k % 10 == 5, F.lit("1234567")).otherwise(F.lit("text"))
    return P.table(spark, sf_dir, "part").select(F.floor(k / 10).cast("long").alias("page_no"), (k % 10).alias("pos"), words.alias("text"), (k * 53 % 600).alias("left"), (k * 59 % 600).alias("top"), (F.col("p_size") % 7 * 10).alias("width"), (k * 7 % 100).alias("conf"))


_TOKENS = """SELECT CAST(floor(p_partkey / 10) AS BIGINT) AS page_no, p_partkey % 10 AS pos, CASE WHEN p_partkey % 10 = 0 THEN lpad(CAST(p_partkey % 1000000 AS VARCHAR), 6, '1') WHEN p_partkey % 10 < 4 THEN CAST(p_partkey % 10 AS VARCHAR) WHEN p_partkey % 10 = 4 THEN lpad(CAST(p_partkey AS VARCHAR), 7, '2') WHEN p_partkey % 10 = 5 THEN '1234567' ELSE 'text' END AS text,
  p_partkey * 53 % 600 AS l, p_partkey * 59 % 600 AS tp, p_size % 7 * 10 AS w, p_partkey * 7 % 100 AS conf FROM part"""


def special_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.special_id(_tokens(spark, sf_dir))


def numeric_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.numeric_tokens(_tokens(spark, sf_dir)).select("page_no", "pos", "text")


QUERIES = [
    (text_normalise, f"SELECT doc_id, {_NORM} AS text FROM documents"),
    (text_jaccard, _PAIRS + " SELECT doc_id, item_id, round(n / (na + nb - n), 6) AS jaccard FROM j"),
    (text_containment, _PAIRS + " SELECT doc_id, item_id, round(n / least(na, nb), 6) AS containment FROM j"),
    (text_sequence_ratio, None),
    (text_compare, None),
    (numeric_target, r"WITH r AS (SELECT doc_id, regexp_extract(text, '([0-9]{6}\s*[0-9])', 1) AS f, regexp_extract_all(text, '[0-9]+') AS runs FROM documents) SELECT doc_id, CASE WHEN f <> '' THEN replace(f, ' ', '') WHEN len(runs) > 0 THEN list_extract(list_filter(runs, lambda x: len(x) = list_max(list_transform(runs, lambda y: len(y)))), 1) END AS target FROM r"),
    (
        special_id,
        f"""WITH t AS ({_TOKENS}), six AS (SELECT page_no, pos, text, l, tp FROM t WHERE regexp_full_match(text, '[0-9]{{6}}')), one AS (SELECT page_no, pos, text, l, tp FROM t WHERE regexp_full_match(text, '[0-9]')),
  n AS (SELECT s.page_no, s.pos, s.text || o.text AS v, row_number() OVER (PARTITION BY s.page_no ORDER BY s.pos, sqrt((o.l - s.l) ** 2 + (o.tp - s.tp) ** 2), o.pos) AS r FROM six s JOIN one o ON s.page_no = o.page_no AND o.l > s.l),
  sv AS (SELECT page_no, text, row_number() OVER (PARTITION BY page_no ORDER BY pos) AS r FROM t WHERE regexp_full_match(text, '[0-9]{{7}}') AND text <> '1234567')
SELECT p.page_no, coalesce(n.v, sv.text) AS special_id FROM (SELECT DISTINCT page_no FROM t) p LEFT JOIN n ON n.page_no = p.page_no AND n.r = 1 LEFT JOIN sv ON sv.page_no = p.page_no AND sv.r = 1""",
    ),
    (numeric_tokens, f"WITH t AS ({_TOKENS}) SELECT page_no, pos, text FROM t WHERE regexp_full_match(text, '[0-9]+') AND conf > 50"),
]
