"""Queries over hashes, costs and assignments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.operators import assign, decide, vectors
from veilframe.plans import proxies as P

_BITS = """, s AS (SELECT subject_id, k, embedding AS e, list_extract(list_sort(embedding[2:64]), 32) AS med FROM v),
  d AS (SELECT subject_id, k, list_transform(e, lambda x: CASE WHEN x > med THEN 1 ELSE 0 END) AS bits FROM s),
  c AS (SELECT a.subject_id, a.k AS page_no, b.k - 3 AS template_no, CAST(list_sum(list_transform(range(1, 65), lambda i: CASE WHEN a.bits[i] <> b.bits[i] THEN 1 ELSE 0 END)) AS BIGINT) AS cost FROM d a JOIN d b ON a.subject_id = b.subject_id AND a.k < 3 AND b.k >= 3)"""


def _hashes(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    x = P.frame(spark, sf_dir, P.PAGEHASH).select("subject_id", "k", vectors.hash_bits(F.col("embedding")).alias("bits"))
    return x.filter("k < 3").select("subject_id", F.col("k").alias("page_no"), "bits"), x.filter("k >= 3").select("subject_id", (F.col("k") - 3).alias("template_no"), "bits")


def hash_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = P.table(spark, sf_dir, "embeddings").select("vec_id", vectors.hash_bits(F.col("embedding")).alias("b"))
    return x.select("vec_id", F.bit_count("b").cast("long").alias("n_set"), (F.col("b") < 0).alias("first_set"), F.col("b").bitwiseAND(F.lit(1)).cast("long").alias("last_bit"))


def hash_cost_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.cost_matrix(*_hashes(spark, sf_dir))


def hash_best_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.best_and_second(hash_cost_matrix(spark, sf_dir))


def mutual_nn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.mutual_nearest(hash_cost_matrix(spark, sf_dir))


def two_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(hash_cost_matrix(spark, sf_dir), 2)


def ratio_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.ratio_test(hash_cost_matrix(spark, sf_dir))


def best_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = hash_cost_matrix(spark, sf_dir).select("subject_id", "page_no", F.concat(F.lit("q_"), F.col("template_no").cast("string")).alias("template"), F.col("template_no").alias("pos"), F.greatest(F.lit(0), 30 - F.col("cost")).cast("long").alias("n_good"))
    return vectors.best_template(good, ["subject_id", "page_no"])


def best_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.best_n(hash_cost_matrix(spark, sf_dir), 4)


def near_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes less than 8 bits apart, among those of the vectors and copies of them (ids below 0) whose last 0 to 9 bits are flipped."""
    x = P.table(spark, sf_dir, "embeddings").select("vec_id", vectors.hash_bits(F.col("embedding")).alias("bits"))
    flipped = F.col("bits").bitwiseXOR((F.pow(F.lit(2.0), F.col("vec_id") % 10) - 1).cast("long"))
    x = x.unionByName(x.select((-1 - F.col("vec_id")).alias("vec_id"), flipped.alias("bits")))
    a, b = x.withColumnRenamed("vec_id", "a_id"), x.withColumnRenamed("vec_id", "b_id")
    c = vectors.bit_slice_candidates(a, b, 8, 8).filter("a_id < b_id").join(a, "a_id").join(b.withColumnRenamed("bits", "bb"), "b_id")
    return c.select("a_id", "b_id", vectors.hamming(F.col("bits"), F.col("bb")).alias("cost")).filter("cost < 8")


def open_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the first stage leaves for the second: pairs of pages and templates without a sure match, less those it tested."""
    costs = hash_cost_matrix(spark, sf_dir)
    sure = vectors.mutual_nearest(costs).filter("cost < 28")
    zipped = costs.filter("page_no = template_no")
    return decide.open_pairs(costs.select("subject_id", "page_no").distinct(), costs.select("subject_id", "template_no").distinct(), sure, zipped)


def second_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs matched by their hashes, with the checks of those whose numbers are not 1 and 1: too costly pairs and unchecked ones don't match."""
    costs = hash_cost_matrix(spark, sf_dir)
    checks = costs.filter("page_no + template_no <> 2").withColumn("matched", F.col("cost") < 28)
    return decide.second_stage(vectors.mutual_nearest(costs), checks).select("subject_id", "page_no", "template_no", "matched")


def assign_total_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = assign.assign(hash_cost_matrix(spark, sf_dir))
    return x.groupBy("subject_id").agg(F.sum("cost").cast("long").alias("total_cost"), F.count("*").alias("n"))


def assign_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign.assign(hash_cost_matrix(spark, sf_dir))


def assign_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = hash_cost_matrix(spark, sf_dir)
    return assign.summary(assign.report(costs, assign.assign(costs)))


def match_disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = hash_cost_matrix(spark, sf_dir)
    first = vectors.nearest(costs, 1).select("subject_id", "page_no", "template_no")
    return assign.disagreeing(first, vectors.mutual_nearest(costs))


def variant_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = hash_cost_matrix(spark, sf_dir).filter("template_no < 2")
    totals = costs.groupBy("subject_id", F.col("template_no").alias("pos")).agg(F.sum("cost").alias("cost")).withColumn("variant", F.concat(F.lit("v"), "pos"))
    return assign.variant(totals)


def region_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = hash_cost_matrix(spark, sf_dir).select("subject_id", "page_no", F.lit(0).alias("template_no"), F.col("template_no").alias("pos"), (F.col("cost") < 32).alias("matched"), (F.col("cost") / 64).alias("confidence"))
    return assign.region_check(r).select("subject_id", "page_no", "n_matched", "matched", F.round(F.array_max("confidences"), 6).alias("best"))


def vector_ncc(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = P.table(spark, sf_dir, "embeddings")
    a, b = x.filter("vec_id % 2 = 0").select("vec_id", F.col("embedding").alias("a")), x.filter("vec_id % 2 = 1").select((F.col("vec_id") - 1).alias("vec_id"), F.slice("embedding", 1, 48).alias("b"))
    return a.join(b, "vec_id").select("vec_id", F.round(vectors.cropped_correlation(F.col("a"), F.col("b")), 5).alias("ncc"))


def profile_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = P.table(spark, sf_dir, "embeddings").select("vec_id", vectors.z_score(F.col("embedding")).alias("z"))
    return x.select("vec_id", F.round(F.col("z")[0], 5).alias("z0"), F.round(F.array_max("z"), 5).alias("z_max"), F.size("z").cast("long").alias("n"))


def black_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.table(spark, sf_dir, "part").select("p_partkey", F.round(vectors.black_change(F.col("p_size"), (F.col("p_partkey") % 50 + 1)), 6).alias("change"))


_RANK = ", r AS (SELECT *, row_number() OVER (PARTITION BY subject_id, page_no ORDER BY cost, template_no) AS place FROM c)"
_MIN = """, x AS (SELECT subject_id, cost, page_no, template_no FROM c), a AS (SELECT p.subject_id, p.cost + q.cost + r.cost AS total FROM x p JOIN x q ON p.subject_id = q.subject_id JOIN x r ON p.subject_id = r.subject_id
  WHERE p.page_no = 0 AND q.page_no = 1 AND r.page_no = 2 AND p.template_no <> q.template_no AND p.template_no <> r.template_no AND q.template_no <> r.template_no)"""
QUERIES = [
    (hash_bits, "WITH s AS (SELECT vec_id, embedding AS e, list_extract(list_sort(embedding[2:64]), 32) AS med FROM embeddings), d AS (SELECT vec_id, list_transform(e, lambda x: CASE WHEN x > med THEN 1 ELSE 0 END) AS b FROM s) SELECT vec_id, CAST(list_sum(b) AS BIGINT) AS n_set, b[1] = 1 AS first_set, CAST(b[64] AS BIGINT) AS last_bit FROM d"),
    (hash_cost_matrix, P.with_views(_BITS + " SELECT * FROM c", v=P.PAGEHASH)),
    (hash_best_second, P.with_views(_BITS + _RANK + " SELECT subject_id, page_no, min(cost) AS best, max(cost) AS second, max(cost) - min(cost) AS gap FROM r WHERE place <= 2 GROUP BY 1, 2", v=P.PAGEHASH)),
    (mutual_nn, P.with_views(_BITS + ", r AS (SELECT *, row_number() OVER (PARTITION BY subject_id, page_no ORDER BY cost, template_no) AS a, row_number() OVER (PARTITION BY subject_id, template_no ORDER BY cost, page_no) AS b FROM c) SELECT subject_id, page_no, template_no, cost FROM r WHERE a = 1 AND b = 1", v=P.PAGEHASH)),
    (two_nearest, P.with_views(_BITS + _RANK + " SELECT subject_id, page_no, template_no, cost, CAST(place AS BIGINT) AS place FROM r WHERE place <= 2", v=P.PAGEHASH)),
    (ratio_test, P.with_views(_BITS + _RANK + " SELECT a.subject_id, a.page_no, a.template_no, a.cost, b.cost AS second FROM r a JOIN r b ON a.subject_id = b.subject_id AND a.page_no = b.page_no AND a.place = 1 AND b.place = 2 WHERE a.cost < 0.7 * b.cost", v=P.PAGEHASH)),
    (best_template, P.with_views(_BITS + " SELECT DISTINCT ON (subject_id, page_no) subject_id, page_no, CASE WHEN cost < 30 THEN 'q_' || template_no END AS template, CAST(greatest(0, 30 - cost) AS BIGINT) AS n_good FROM c ORDER BY subject_id, page_no, greatest(0, 30 - cost) DESC, template_no", v=P.PAGEHASH)),
    (best_n, P.with_views(_BITS + ", r AS (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY cost, page_no, template_no) AS place FROM c) SELECT subject_id, page_no, template_no, cost, CAST(place AS BIGINT) AS place FROM r WHERE place <= 4", v=P.PAGEHASH)),
    (near_hashes, "WITH s AS (SELECT vec_id, embedding AS e, list_extract(list_sort(embedding[2:64]), 32) AS med FROM embeddings), o AS (SELECT vec_id, list_transform(e, lambda x: CASE WHEN x > med THEN 1 ELSE 0 END) AS b FROM s), d AS (SELECT * FROM o UNION ALL SELECT -1 - vec_id, list_transform(range(1, 65), lambda i: CASE WHEN i > 64 - vec_id % 10 THEN 1 - b[i] ELSE b[i] END) FROM o), p AS (SELECT a.vec_id AS a_id, b.vec_id AS b_id, CAST(64 - list_sum(a.b) - list_sum(b.b) AS BIGINT) AS u, CAST(list_inner_product(a.b::DOUBLE[], b.b::DOUBLE[]) AS BIGINT) AS common, CAST(list_sum(a.b) + list_sum(b.b) AS BIGINT) AS n FROM d a JOIN d b ON a.vec_id < b.vec_id) SELECT a_id, b_id, n - 2 * common AS cost FROM p WHERE n - 2 * common < 8"),
    (open_pairs, P.with_views(_BITS + ", r AS (SELECT *, row_number() OVER (PARTITION BY subject_id, page_no ORDER BY cost, template_no) AS a, row_number() OVER (PARTITION BY subject_id, template_no ORDER BY cost, page_no) AS b FROM c), m AS (SELECT * FROM r WHERE a = 1 AND b = 1 AND cost < 28) SELECT subject_id, page_no, template_no FROM c WHERE page_no <> template_no AND NOT EXISTS (SELECT 1 FROM m WHERE m.subject_id = c.subject_id AND m.page_no = c.page_no) AND NOT EXISTS (SELECT 1 FROM m WHERE m.subject_id = c.subject_id AND m.template_no = c.template_no)", v=P.PAGEHASH)),
    (second_stage, P.with_views(_BITS + ", r AS (SELECT *, row_number() OVER (PARTITION BY subject_id, page_no ORDER BY cost, template_no) AS a, row_number() OVER (PARTITION BY subject_id, template_no ORDER BY cost, page_no) AS b FROM c) SELECT subject_id, page_no, template_no, page_no + template_no <> 2 AND cost < 28 AS matched FROM r WHERE a = 1 AND b = 1", v=P.PAGEHASH)),
    (assign_total_cost, P.with_views(_BITS + _MIN + " SELECT subject_id, min(total) AS total_cost, 3::BIGINT AS n FROM a GROUP BY 1", v=P.PAGEHASH)),
    (assign_pages, None),
    (assign_report, None),
    (match_disagreement, P.with_views(_BITS + ", r AS (SELECT *, row_number() OVER (PARTITION BY subject_id, page_no ORDER BY cost, template_no) AS a, row_number() OVER (PARTITION BY subject_id, template_no ORDER BY cost, page_no) AS b FROM c) SELECT subject_id, page_no, template_no AS a, NULL::BIGINT AS b FROM r WHERE a = 1 AND b > 1", v=P.PAGEHASH)),
    (variant_choice, P.with_views(_BITS + ", t AS (SELECT subject_id, template_no, sum(cost) AS s FROM c WHERE template_no < 2 GROUP BY 1, 2) SELECT DISTINCT ON (subject_id) subject_id, 'v' || template_no AS variant FROM t ORDER BY subject_id, s, template_no", v=P.PAGEHASH)),
    (region_check, P.with_views(_BITS + " SELECT subject_id, page_no, count_if(cost < 32) AS n_matched, count_if(cost < 32) >= 2 AS matched, round(max(cost) / 64.0::DOUBLE, 6) AS best FROM c GROUP BY 1, 2", v=P.PAGEHASH)),
    (vector_ncc, "WITH j AS (SELECT a.vec_id, CAST(a.embedding[9:56] AS DOUBLE[]) AS x, CAST(b.embedding[1:48] AS DOUBLE[]) AS y FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 2 = 0), m AS (SELECT vec_id, list_transform(x, lambda v: v - list_avg(x)) AS dx, list_transform(y, lambda v: v - list_avg(y)) AS dy FROM j) SELECT vec_id, round(list_inner_product(dx, dy) / (sqrt(list_inner_product(dx, dx)) * sqrt(list_inner_product(dy, dy)) + 1e-6), 5) AS ncc FROM m"),
    (profile_zscore, "WITH m AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), d AS (SELECT vec_id, list_transform(x, lambda v: v - list_avg(x)) AS d FROM m), z AS (SELECT vec_id, list_transform(d, lambda v: v / CASE WHEN sqrt(list_inner_product(d, d) / len(d)) < 1e-6 THEN 1 ELSE sqrt(list_inner_product(d, d) / len(d)) END) AS z FROM d) SELECT vec_id, round(z[1], 5) AS z0, round(list_max(z), 5) AS z_max, CAST(len(z) AS BIGINT) AS n FROM z"),
    (black_change, "SELECT p_partkey, round((p_size - (p_partkey % 50 + 1)) / ((p_partkey % 50 + 1) + 1e-10::DOUBLE), 6) AS change FROM part"),
]
