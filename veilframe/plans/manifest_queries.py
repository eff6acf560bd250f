"""Queries over manifests and ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.operators import audit, decide, ledger, manifest
from veilframe.plans import proxies as P

_PREPARED = """, nn AS (SELECT subject_id, regexp_replace(object_name, '[.][^.]*$', '') AS object_name FROM m WHERE subject_id IS NOT NULL AND object_name IS NOT NULL),
  amb AS (SELECT object_name FROM nn GROUP BY object_name HAVING count(DISTINCT subject_id) > 1),
  prep AS (SELECT DISTINCT subject_id, object_name FROM nn WHERE object_name NOT IN (SELECT object_name FROM amb))"""


def _manifest(spark, sf_dir):
    return P.frame(spark, sf_dir, P.MANIFEST)


def _prepared(spark, sf_dir):
    return manifest.prepare(_manifest(spark, sf_dir))


def _ledger(spark, sf_dir):
    return P.frame(spark, sf_dir, P.LEDGER)


def _listing(spark, sf_dir):
    return P.frame(spark, sf_dir, P.LISTING)


def manifest_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir)


def manifest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.manifest_audit(_manifest(spark, sf_dir))


def manifest_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.null_counts(_manifest(spark, sf_dir).select("subject_id", "object_name"))


def manifest_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.ambiguous_names(_manifest(spark, sf_dir))


def manifest_last_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.last_id_of_name(_manifest(spark, sf_dir))


def manifest_name_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("object_name")
    return _manifest(spark, sf_dir).select("ingest_pos", manifest.strip_last_suffix(n).alias("up_to_last"), manifest.strip_first_suffix(n).alias("up_to_first"), manifest.page_number(n).cast("long").alias("page_no"), manifest.ends_with(n, ".tif").alias("is_tif"), manifest.holds(n, "shared").alias("is_shared"))


def manifest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.full_report(_manifest(spark, sf_dir), _listing(spark, sf_dir))


def manifest_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = _listing(spark, sf_dir).select(manifest.strip_first_suffix(F.col("path")).alias("object_name"))
    return manifest.differences(_prepared(spark, sf_dir), listed, "object_name")


def names_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = P.table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("k"))
    b = P.table(spark, sf_dir, "region").filter("r_regionkey > 0").select(F.col("r_regionkey").cast("string").alias("k"))
    x = manifest.names_match(a, b, "k")
    return x.select(F.concat_ws(",", "missing").alias("missing"), F.concat_ws(",", "extra").alias("extra"), "same")


def manifest_resolve_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.resolve_files(_prepared(spark, sf_dir).select("subject_id", "object_name"), _listing(spark, sf_dir))


def manifest_existence(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _prepared(spark, sf_dir).select(F.concat("object_name", F.lit(".pdf")).alias("object_name"))
    return manifest.existence(names, _listing(spark, sf_dir))


def files_per_id_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.files_per_id(_manifest(spark, sf_dir))


def template_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = P.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("q"))
    return q.select("q", F.concat_ws(",", manifest.template_names(F.col("q"))).alias("templates"))


def ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.latest(_ledger(spark, sf_dir))


def ledger_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.frequencies(_ledger(spark, sf_dir), "status")


def ledger_not_successful(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.without_status(_ledger(spark, sf_dir)).groupBy("subject_id").agg(F.count("*").alias("n"))


def ledger_distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.distinct_ids(_ledger(spark, sf_dir))


def ledger_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.slowest(_ledger(spark, sf_dir))


def ledger_time_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.time_stats(_ledger(spark, sf_dir))


def ledger_speed_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = P.table(spark, sf_dir, "nation").groupBy((F.col("n_regionkey") + 1).cast("long").alias("workers")).agg((F.lit(1000.0) / (F.min("n_nationkey") + 1)).alias("secs"))
    x = ledger.speed_up(runs)
    return x.select("workers", *[F.round(c, 6).alias(c) for c in ("secs", "speed_up", "efficiency")])


def _done(spark, sf_dir):
    return ledger.with_status(_ledger(spark, sf_dir))


def ledger_mark_used(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.mark_used(_prepared(spark, sf_dir).select("subject_id", "object_name", "used"), _done(spark, sf_dir))


def remaining_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.remaining(ledger_mark_used(spark, sf_dir)).select("subject_id", "object_name")


def shard_contiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.contiguous_shard(P.table(spark, sf_dir, "customer").select("c_custkey"), 7, "c_custkey")


def shard_strided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.strided_shard(P.table(spark, sf_dir, "customer").select("c_custkey"), 7, "c_custkey")


def sample_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.sample_ids(_prepared(spark, sf_dir), 20, 1)


def warning_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.warning_texts(P.frame(spark, sf_dir, P.OUTCOME))


def page_extraction_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide.extraction_plan(P.frame(spark, sf_dir, P.FILES))


def unreadable_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide.unreadable(P.frame(spark, sf_dir, P.FILES))


def decision_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide.decision(P.frame(spark, sf_dir, P.OUTCOME))


def stage1_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = P.frame(spark, sf_dir, P.OUTCOME)
    templates = o.filter("matched_template IS NOT NULL").select("subject_id", F.col("matched_template").alias("template_no")).distinct()
    return decide.zip_pairs(o.select("subject_id", "page_no"), templates)


def stage1_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = decide.first_stage(stage1_pairs(spark, sf_dir).withColumn("matched", (F.col("page_no") + F.col("template_no")) % 3 > 0))
    return x.select("subject_id", "passed", F.concat_ws(",", F.transform("open_pages", lambda v: v.cast("string"))).alias("open_pages"), F.concat_ws(",", F.transform("open_templates", lambda v: v.cast("string"))).alias("open_templates"))


_PROFILE = "(VALUES " + ", ".join(f"({p[0]}, {p[1]}, '{p[2]}')" for p in decide.PROFILES) + ") AS t(q, expected, ord)"
_ZIP = """, t AS (SELECT DISTINCT subject_id, matched_template AS template_no FROM o WHERE matched_template IS NOT NULL),
  pr AS (SELECT subject_id, page_no, row_number() OVER (PARTITION BY subject_id ORDER BY page_no) AS r FROM o),
  tr AS (SELECT subject_id, template_no, row_number() OVER (PARTITION BY subject_id ORDER BY template_no) AS r FROM t),
  z AS (SELECT pr.subject_id, page_no, template_no, CAST(pr.r AS BIGINT) AS place FROM pr JOIN tr ON pr.subject_id = tr.subject_id AND pr.r = tr.r)"""

QUERIES = [
    (manifest_prepare, P.with_views(_PREPARED + " SELECT subject_id, object_name, false AS used, '' AS warning_ordering, '' AS warning_censoring FROM prep", m=P.MANIFEST)),
    (
        manifest_audit,
        _AUDIT := P.with_views(
            """, p AS (SELECT object_name, subject_id, count(*) AS n FROM m GROUP BY ALL),
  bn AS (SELECT object_name, sum(n) AS n, count(subject_id) AS ids FROM p WHERE object_name IS NOT NULL GROUP BY 1), bi AS (SELECT subject_id, sum(n) AS n FROM p WHERE subject_id IS NOT NULL GROUP BY 1)
SELECT count(*) AS n_rows, count_if(object_name IS NULL) AS null_names, count_if(subject_id IS NULL) AS null_ids, count_if(object_name IS NULL AND subject_id IS NULL) AS null_both,
  count_if(coalesce(object_name LIKE '%.tif', false)) AS tif_names, count_if(coalesce(object_name LIKE '%.pdf%', false)) AS pdf_names, count(*) - (SELECT count(*) FROM p) AS repeated_rows,
  (SELECT count(*) FROM bn) AS n_names, (SELECT count_if(n > 1) FROM bn) AS repeated_names, (SELECT count_if(ids > 1) FROM bn) AS ambiguous_names,
  (SELECT count(*) FROM bi) AS n_ids, CAST((SELECT max(n) FROM bi) AS BIGINT) AS most_files, (SELECT count(DISTINCT n) FROM bi) AS distinct_counts FROM m""",
            m=P.MANIFEST,
    ),
    ),
    (manifest_null_counts, P.with_views(" SELECT count_if(subject_id IS NULL) AS subject_id, count_if(object_name IS NULL) AS object_name FROM m", m=P.MANIFEST)),
    (manifest_ambiguous, P.with_views(" SELECT object_name, count(DISTINCT subject_id) AS n_ids FROM m GROUP BY 1 HAVING count(DISTINCT subject_id) > 1", m=P.MANIFEST)),
    (manifest_last_id, P.with_views(" SELECT object_name, arg_max(subject_id, ingest_pos) FILTER (true) AS subject_id FROM (SELECT DISTINCT ON (object_name) object_name, subject_id, ingest_pos FROM m WHERE object_name IS NOT NULL ORDER BY object_name, ingest_pos DESC) GROUP BY 1", m=P.MANIFEST)),
    (
        manifest_name_parts,
        P.with_views(
            " SELECT ingest_pos, regexp_replace(object_name, '[.][^.]*$', '') AS up_to_last, split_part(object_name, '.', 1) AS up_to_first, try_cast(list_extract(string_split(regexp_replace(object_name, '[.][^.]*$', ''), '_'), -1) AS BIGINT) AS page_no, coalesce(object_name LIKE '%.tif', false) AS is_tif, coalesce(object_name LIKE '%shared%', false) AS is_shared FROM m",
            m=P.MANIFEST,
        ),
    ),
    (
        manifest_report,
        f"""SELECT 'figures' AS section, name AS item, CAST(value AS BIGINT) AS n FROM (UNPIVOT ({_AUDIT}) ON COLUMNS(*) INTO NAME name VALUE value)
UNION ALL SELECT 'figures', 'no_suffix', CAST(count(*) AS BIGINT) FROM ({P.plain(P.MANIFEST)}) WHERE object_name IS NOT NULL AND NOT contains(object_name, '.')
UNION ALL SELECT 'files_per_id', CAST(k AS VARCHAR), count(*) FROM (SELECT count(*) AS k FROM ({P.plain(P.MANIFEST)}) WHERE subject_id IS NOT NULL GROUP BY subject_id) GROUP BY k
UNION ALL SELECT 'names', name, value FROM (UNPIVOT (
  SELECT count(a) AS in_table, count(b) AS in_folder, CAST(sum(CASE WHEN b IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS only_in_table, CAST(sum(CASE WHEN a IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS only_in_folder FROM
  (SELECT DISTINCT regexp_replace(object_name, '[.][^.]*$', '') AS a FROM ({P.plain(P.MANIFEST)}) WHERE object_name IS NOT NULL) FULL JOIN
  (SELECT DISTINCT regexp_replace(path, '[.][^.]*$', '') AS b FROM ({P.plain(P.LISTING)}) WHERE path IS NOT NULL) ON a = b) ON COLUMNS(*) INTO NAME name VALUE value)""",
    ),
    (
        manifest_reconcile,
        P.with_views(
            _PREPARED
            + """, l AS (SELECT DISTINCT split_part(path, '.', 1) AS object_name FROM listing), a AS (SELECT DISTINCT object_name FROM prep),
  o AS (SELECT 'left' AS side, object_name FROM a WHERE object_name NOT IN (SELECT object_name FROM l) UNION ALL SELECT 'right', object_name FROM l WHERE object_name NOT IN (SELECT object_name FROM a))
SELECT side, count(*) AS n, array_to_string(list_slice(list(object_name ORDER BY object_name), 1, 3), ',') AS examples FROM o GROUP BY side""",
            m=P.MANIFEST,
            listing=P.LISTING,
        ),
    ),
    (names_match, "SELECT '0' AS missing, '' AS extra, false AS same FROM region WHERE r_regionkey = 0"),
    (manifest_resolve_files, P.with_views(_PREPARED + " SELECT subject_id, object_name, coalesce(a.path, b.path) AS path FROM prep LEFT JOIN (SELECT DISTINCT path FROM listing) a ON a.path = object_name || '.pdf' LEFT JOIN (SELECT DISTINCT path FROM listing) b ON b.path = object_name || '.tif.pdf'", m=P.MANIFEST, listing=P.LISTING)),
    (manifest_existence, P.with_views(_PREPARED + " SELECT count(*) AS listed, count(path) AS present FROM prep LEFT JOIN (SELECT DISTINCT path FROM listing) ON path = object_name || '.pdf'", m=P.MANIFEST, listing=P.LISTING)),
    (files_per_id_distribution, P.with_views(" SELECT n_files, count(*) AS n_ids FROM (SELECT subject_id, count(*) AS n_files FROM m WHERE subject_id IS NOT NULL GROUP BY 1) GROUP BY 1", m=P.MANIFEST)),
    (template_names, "SELECT CAST(n_nationkey AS BIGINT) AS q, CASE WHEN n_nationkey IN (1, 8) THEN 'q_' || n_nationkey || ',q_' || n_nationkey || 'v2' WHEN n_nationkey BETWEEN 1 AND 13 THEN 'q_' || n_nationkey ELSE '' END AS templates FROM nation"),
    (ledger_latest, P.with_views(" SELECT DISTINCT ON (subject_id) ingest_pos, subject_id, status, secs FROM l ORDER BY subject_id, ingest_pos DESC", l=P.LEDGER)),
    (ledger_status_counts, P.with_views(" SELECT status, count(*) AS n FROM l GROUP BY 1", l=P.LEDGER)),
    (ledger_not_successful, P.with_views(" SELECT subject_id, count(*) AS n FROM l WHERE status IS DISTINCT FROM 'success' GROUP BY 1", l=P.LEDGER)),
    (ledger_distinct_ids, P.with_views(" SELECT count(DISTINCT subject_id) AS n_ids, count(DISTINCT subject_id) FILTER (status = 'success') AS n_success, count(DISTINCT subject_id) FILTER (status IS DISTINCT FROM 'success') AS n_other FROM l", l=P.LEDGER)),
    (ledger_top5, P.with_views(" SELECT ingest_pos, subject_id, status, secs FROM l ORDER BY secs DESC NULLS LAST, ingest_pos LIMIT 5", l=P.LEDGER)),
    (ledger_time_stats, P.with_views(" SELECT round(avg(secs), 6) AS mean_secs, count_if(secs > 100) AS n_over, count(secs) AS n_timed FROM l", l=P.LEDGER)),
    (ledger_speed_up, "WITH r AS (SELECT CAST(n_regionkey + 1 AS BIGINT) AS workers, 1000.0 / (min(n_nationkey) + 1) AS secs FROM nation GROUP BY 1), s AS (SELECT workers, CAST(secs AS DOUBLE) AS secs, CAST(first_value(secs) OVER (ORDER BY workers) AS DOUBLE) / secs AS speed_up FROM r) SELECT workers, round(secs, 6) AS secs, round(speed_up, 6) AS speed_up, round(100 * speed_up / workers, 6) AS efficiency FROM s"),
    (ledger_mark_used, P.with_views(_PREPARED + " SELECT subject_id, object_name, subject_id IN (SELECT subject_id FROM l WHERE status = 'success') AS used FROM prep", m=P.MANIFEST, l=P.LEDGER)),
    (remaining_work, P.with_views(_PREPARED + " SELECT subject_id, object_name FROM prep WHERE subject_id NOT IN (SELECT subject_id FROM l WHERE status = 'success')", m=P.MANIFEST, l=P.LEDGER)),
    (shard_contiguous, "WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS r, count(*) OVER () AS n FROM customer) SELECT c_custkey, CAST(CASE WHEN n < 7 THEN 6 ELSE least(floor((r - 1) / floor(n / 7)), 6) END AS BIGINT) AS shard FROM r"),
    (shard_strided, "SELECT c_custkey, CAST((row_number() OVER (ORDER BY c_custkey) - 1) % 7 AS BIGINT) AS shard FROM customer"),
    (sample_subjects, P.with_views(_PREPARED + " SELECT subject_id, object_name, false AS used, '' AS warning_ordering, '' AS warning_censoring FROM prep WHERE subject_id IN (SELECT subject_id FROM prep WHERE subject_id IS NOT NULL GROUP BY 1 ORDER BY md5('1/' || subject_id), 1 LIMIT 20)", m=P.MANIFEST)),
    (
        warning_rollup,
        P.with_views(
            """, g AS (SELECT subject_id, bool_or(passed_1) AS p1, bool_or(passed_2) AS p2, count_if(matched_template IS NULL OR 1 - ocr_similarity > 0.3) AS k, count(*) AS n, count_if(large_boxes) AS big FROM o GROUP BY 1)
SELECT subject_id, CASE WHEN p1 THEN 'First stage' WHEN p2 THEN 'Second stage' ELSE 'OCR stage, pages with warning:   ' || k || '/' || n END AS warning_ordering,
  CASE WHEN big > 0 THEN 'pages censored with large boxes:   ' || big || '/' || n ELSE 'No warning' END AS warning_censoring FROM g""",
            o=P.OUTCOME,
        ),
    ),
    (
        page_extraction_plan,
        P.with_views(
            f""", x AS (SELECT f.*, expected, ord, CASE WHEN ord = 'alphabetical' THEN row_number() OVER (PARTITION BY subject_id ORDER BY object_name) ELSE row_number() OVER (PARTITION BY subject_id ORDER BY object_name DESC) END AS place FROM f JOIN {_PROFILE} ON q = questionnaire),
  b AS (SELECT *, CASE WHEN n_pages > 1 THEN row_number() OVER (PARTITION BY subject_id, n_pages > 1 ORDER BY n_pages DESC, place) = 1 ELSE false END AS best, max(CASE WHEN n_pages > 1 THEN n_pages ELSE 0 END) OVER (PARTITION BY subject_id) AS largest FROM x),
  t AS (SELECT *, CASE WHEN best THEN least(n_pages, 2 * expected) WHEN n_pages = 1 AND largest < expected THEN 1 ELSE 0 END AS take FROM b),
  j AS (SELECT *, unnest(range(0, CAST(take AS BIGINT))) AS j FROM t WHERE take > 0)
SELECT subject_id, CAST(row_number() OVER (PARTITION BY subject_id ORDER BY NOT best, place, j) AS BIGINT) AS page_no, object_name, CAST(CASE WHEN best AND ord <> 'alphabetical' THEN n_pages - 1 - j WHEN best THEN j ELSE 0 END AS BIGINT) AS page_index FROM j""",
            f=P.FILES,
        ),
    ),
    (unreadable_subjects, P.with_views(" SELECT subject_id FROM f GROUP BY 1 HAVING max(coalesce(n_pages, 0)) = 0", f=P.FILES)),
    (
        decision_policy,
        P.with_views(
            """, s AS (SELECT *, CASE WHEN passed_1 THEN 1 WHEN passed_2 THEN 2 ELSE 3 END AS stage FROM o), w AS (SELECT *, matched_template IS NULL OR 1 - ocr_similarity > 0.3 AS warned FROM s)
SELECT subject_id, page_no, CAST(stage AS BIGINT) AS stage, matched_template IS NULL OR (stage = 3 AND warned) AS warning,
  CASE WHEN matched_template IS NULL OR (stage = 3 AND warned AND 1 - ocr_similarity > 0.7) THEN 'omit' WHEN page_type = 'N' THEN 'pass' WHEN large_boxes THEN 'large_boxes' ELSE 'close_boxes' END AS action FROM w""",
            o=P.OUTCOME,
        ),
    ),
    (stage1_pairs, P.with_views(_ZIP + " SELECT * FROM z", o=P.OUTCOME)),
    (stage1_outcome, P.with_views(_ZIP + " SELECT subject_id, bool_and((page_no + template_no) % 3 > 0) AS passed, coalesce(string_agg(page_no, ',' ORDER BY page_no) FILTER ((page_no + template_no) % 3 = 0), '') AS open_pages, coalesce(string_agg(template_no, ',' ORDER BY template_no) FILTER ((page_no + template_no) % 3 = 0), '') AS open_templates FROM z GROUP BY 1", o=P.OUTCOME)),
]
