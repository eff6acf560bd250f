"""The staged decision which template a page is, which files' pages to take, and how a page is redacted.

Stages are tables: each works on what the ones before left open, by anti joins, so a costly test runs on few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed: pages, order and storage of each questionnaire.
PROFILES = [(1, 4, "alphabetical", "multi-page"), (2, 8, "random", "multi-page"), (3, 2, "alphabetical", "multi-page"), (4, 4, "reverse", "multi-page"), (5, 4, "reverse", "multi-page"), (6, 4, "alphabetical", "multi-page"), (7, 5, "alphabetical", "multi-page"), (8, 32, "alphabetical", "single"), (9, 4, "alphabetical", "multi-page"), (10, 12, "alphabetical", "single"), (11, 8, "alphabetical", "single"), (12, 12, "alphabetical", "single"), (13, 20, "alphabetical", "single")]
#: OCR costs: beyond the first a page has a warning, beyond the second it is left out.
WARN_COST, DROP_COST = 0.3, 0.7


def _profile(questionnaire: Column, k: int) -> Column:
    out = F.lit(None)
    for p in PROFILES:
        out = F.when(questionnaire == p[0], F.lit(p[k])).otherwise(out)
    return out


def extraction_plan(files: DataFrame, key: str = "subject_id") -> DataFrame:
    """key, page_no, object_name, page_index: which page of which file becomes which page.

    files: key, object_name, n_pages (0: unreadable), questionnaire. Files stand in the questionnaire's order, names ascending
    or else descending. The largest file of several pages (the first of equal ones) gives its pages, twice the expected number
    at most, from the last one in other than alphabetical order; single pages follow if that file is short of the expected
    number. Subjects without a readable file are left out; see `unreadable`. An unknown questionnaire is an error.
    """
    alpha = F.col("ord") == "alphabetical"
    unknown = F.raise_error(F.concat(F.lit("no profile of questionnaire "), F.coalesce(F.col("questionnaire").cast("string"), F.lit("null"))))
    x = files.withColumn("expected", F.coalesce(_profile(F.col("questionnaire"), 1), unknown.cast("int"))).withColumn("ord", _profile(F.col("questionnaire"), 2))
    up, down = Window.partitionBy(key).orderBy("object_name"), Window.partitionBy(key).orderBy(F.desc("object_name"))
    x = x.withColumn("place", F.when(alpha, F.row_number().over(up)).otherwise(F.row_number().over(down)))
    many = F.col("n_pages") > 1
    best = F.min(F.when(many, F.struct((-F.col("n_pages")).alias("n"), "place"))).over(Window.partitionBy(key))
    x = x.withColumn("best", best).withColumn("largest", F.coalesce(-F.col("best.n"), F.lit(0)))
    is_best = many & (F.col("place") == F.col("best.place"))
    take = F.when(is_best, F.least(F.col("n_pages"), 2 * F.col("expected"))).when((F.col("n_pages") == 1) & (F.col("largest") < F.col("expected")), F.lit(1)).otherwise(F.lit(0))
    x = x.withColumn("take", take).filter("take > 0").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("take").cast("int") - 1)))
    index = F.when(is_best & ~alpha, F.col("n_pages") - 1 - F.col("j")).when(is_best, F.col("j")).otherwise(F.lit(0))
    order = Window.partitionBy(key).orderBy(F.when(is_best, 0).otherwise(1), "place", "j")
    return x.select(key, F.row_number().over(order).cast("long").alias("page_no"), "object_name", index.cast("long").alias("page_index"))


def unreadable(files: DataFrame, key: str = "subject_id") -> DataFrame:
    """Subjects none of whose files could be read: no pages, or null."""
    return files.groupBy(key).agg(F.max(F.coalesce("n_pages", F.lit(0))).alias("m")).filter("m = 0").select(key)


def zip_pairs(pages: DataFrame, templates: DataFrame, key: str = "subject_id") -> DataFrame:
    """The first page with the first template and so on, up to the shorter side."""
    p = pages.select(key, "page_no", F.row_number().over(Window.partitionBy(key).orderBy("page_no")).alias("r"))
    t = templates.select(key, "template_no", F.row_number().over(Window.partitionBy(key).orderBy("template_no")).alias("r"))
    return p.join(t, [key, "r"]).select(key, "page_no", "template_no", F.col("r").cast("long").alias("place"))


def first_stage(checked: DataFrame, key: str = "subject_id") -> DataFrame:
    """From pairs with `matched`: whether all of a subject's pairs match, and the pages and templates that don't."""
    bad = lambda c: F.array_sort(F.collect_list(F.when(~F.col("matched"), F.col(c))))
    return checked.groupBy(key).agg(F.bool_and("matched").alias("passed"), bad("page_no").alias("open_pages"), bad("template_no").alias("open_templates"))


def open_pairs(pages: DataFrame, templates: DataFrame, solved: DataFrame, tested: DataFrame, key: str = "subject_id") -> DataFrame:
    """Pairs of pages and templates that are neither solved nor tested; per subject a few hundred at most."""
    p = pages.select(key, "page_no").join(solved.select(key, "page_no"), [key, "page_no"], "left_anti")
    t = templates.select(key, "template_no").join(solved.select(key, "template_no"), [key, "template_no"], "left_anti")
    return p.join(t, key).join(tested.select(key, "page_no", "template_no"), [key, "page_no", "template_no"], "left_anti")


def second_stage(assigned: DataFrame, checks: DataFrame, key: str = "subject_id") -> DataFrame:
    """Assigned pairs whose regions were checked: matched only where the check says so; unchecked pairs aren't."""
    c = checks.select(key, "page_no", "template_no", F.col("matched").alias("ok"))
    return assigned.join(c, [key, "page_no", "template_no"], "left").withColumn("matched", F.coalesce("ok", F.lit(False))).drop("ok")


def solved_once(checks: DataFrame, hash_matches: DataFrame, key: str = "subject_id") -> DataFrame:
    """Templates that matched exactly one page, the one that the hashes give them too."""
    hits = checks.filter("matched").groupBy(key, "template_no").agg(F.count("*").alias("n"), F.min("page_no").alias("page_no")).filter("n = 1").drop("n")
    return hits.join(hash_matches.select(key, "page_no", "template_no"), [key, "page_no", "template_no"], "left_semi")


def ocr_outcome(similarity: Column, template: Column) -> tuple[Column, Column]:
    """Warning and dropped flags of a page at the last stage."""
    cost = 1 - similarity
    warned = template.isNull() | F.coalesce(cost > WARN_COST, F.lit(True))
    return warned, warned & F.coalesce(cost > DROP_COST, F.lit(True))


def decision(pages: DataFrame) -> DataFrame:
    """stage, warning, action for pages with subject_id, page_no, matched_template, passed_1, passed_2, ocr_similarity, large_boxes, page_type.

    action: omit (unmatched, or dropped at the last stage), pass (type N), large_boxes (no usable transform) or close_boxes.
    Doubt redacts more, or leaves the page out; it never lets pixels through.
    """
    stage = F.when(F.col("passed_1"), 1).when(F.col("passed_2"), 2).otherwise(3)
    warned, dropped = ocr_outcome(F.col("ocr_similarity"), F.col("matched_template"))
    last = stage == 3
    warning = F.col("matched_template").isNull() | (last & warned)
    action = F.when(F.col("matched_template").isNull() | (last & dropped), "omit").when(F.col("page_type") == "N", "pass").when(F.coalesce("large_boxes", F.lit(True)), "large_boxes").otherwise("close_boxes")
    return pages.select("subject_id", "page_no", stage.cast("long").alias("stage"), warning.alias("warning"), action.alias("action"))


def transform_choice(found: DataFrame) -> DataFrame:
    """method of each page's transform by what is there: boxes matched beforehand, an affine fit, a homography, or none (scale -1)."""
    m = F.when(F.col("n_shifts") >= 2, "pre_computed").when(F.col("affine_ok"), "orb_page_level_affine").when(F.col("homography_ok"), "orb_page_level_homography").otherwise("failed")
    return found.withColumn("method", m).withColumn("scale", F.when(m == "failed", F.lit(-1.0)).otherwise(F.col("scale")))


def refinement(mode: Column, shift_x: Column, shift_y: Column, scale: Column) -> Column:
    """shift_x, shift_y, scale of the refinement; the two skip modes leave boxes as they are."""
    skip = mode.isin("skip_alignment", "skip_all")
    pick = lambda c, v: F.when(skip, F.lit(v)).otherwise(F.coalesce(c.cast("double"), F.lit(v)))
    return F.struct(pick(shift_x, 0.0).alias("shift_x"), pick(shift_y, 0.0).alias("shift_y"), pick(scale, 1.0).alias("scale"))


def warning_code(vote_before: Column, vote_after: Column) -> Column:
    """Two characters: whether the votes before and after the alignment failed."""
    return F.concat(F.when(vote_before, "0").otherwise("1"), F.when(vote_after, "0").otherwise("1"))


def votes(checks: DataFrame, least: int, key: list[str]) -> DataFrame:
    """ok: as many region checks passed as `least`."""
    return checks.groupBy(*key).agg((F.count_if("ok") >= least).alias("ok"), F.count_if("ok").alias("votes"))
