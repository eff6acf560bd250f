"""Counts that tell whether a manifest can be trusted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.operators.manifest import ends_with, holds, strip_last_suffix


def null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def files_per_id(df: DataFrame, id_: str = "subject_id", name: str = "object_name", distinct: bool = False) -> DataFrame:
    """n_files, n_ids: how many ids have so many files; of distinct (id, name) if asked."""
    x = df.filter(F.col(id_).isNotNull())
    x = x.select(id_, name).distinct() if distinct else x
    return x.groupBy(id_).agg(F.count("*").alias("n_files")).groupBy("n_files").agg(F.count("*").alias("n_ids"))


def manifest_audit(df: DataFrame, name: str = "object_name", id_: str = "subject_id") -> DataFrame:
    """Thirteen figures of a manifest in one row; names and ids are aggregated first, so one pass and two small ones."""
    n, i = F.col(name), F.col(id_)
    pairs = df.groupBy(name, id_).agg(F.count("*").alias("n"))
    # grouping by both keeps null pairs too; all else follows from the counts of pairs
    by_name = pairs.groupBy(name).agg(F.sum("n").alias("n"), F.count(id_).alias("ids"))
    by_id = pairs.filter(i.isNotNull()).groupBy(id_).agg(F.sum("n").alias("n"))
    rows = pairs.agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(n.isNull(), F.col("n"))), F.lit(0)).alias("null_names"), F.coalesce(F.sum(F.when(i.isNull(), F.col("n"))), F.lit(0)).alias("null_ids"),
        F.coalesce(F.sum(F.when(n.isNull() & i.isNull(), F.col("n"))), F.lit(0)).alias("null_both"), F.coalesce(F.sum(F.when(ends_with(n, ".tif"), F.col("n"))), F.lit(0)).alias("tif_names"),
        F.coalesce(F.sum(F.when(holds(n, ".pdf"), F.col("n"))), F.lit(0)).alias("pdf_names"), (F.sum("n") - F.count("*")).alias("repeated_rows"),
    )
    names = by_name.filter(n.isNotNull()).agg(F.count("*").alias("n_names"), F.count_if(F.col("n") > 1).alias("repeated_names"), F.count_if(F.col("ids") > 1).alias("ambiguous_names"))
    ids = by_id.agg(F.count("*").alias("n_ids"), F.max("n").alias("most_files"), F.countDistinct("n").alias("distinct_counts"))
    one = lambda d: d.withColumn("__one", F.lit(1))  # noqa: E731  three rows of one
    return one(rows).join(one(names), "__one").join(one(ids), "__one").drop("__one")


def full_report(df: DataFrame, folder: DataFrame, name: str = "object_name", id_: str = "subject_id", path: str = "path") -> DataFrame:
    """section, item, n: a manifest's figures, its names against a folder's, and how many ids have how many files.

    Suffixes are counted before they are taken off; the folder's names are compared after. Null names match nothing. A few
    dozen rows, from aggregates that are small before they meet.
    """
    n = F.col(name)
    figures = manifest_audit(df, name, id_)
    figures = figures.select(F.explode(F.create_map(*[x for c in figures.columns for x in (F.lit(c), F.col(c).cast("long"))])).alias("item", "n"))
    plain = df.agg(F.count_if(n.isNotNull() & ~holds(n, ".")).alias("n")).select(F.lit("no_suffix").alias("item"), "n")
    own = df.filter(n.isNotNull()).select(strip_last_suffix(n).alias("k")).distinct().withColumn("a", F.lit(True))
    there = folder.filter(F.col(path).isNotNull()).select(strip_last_suffix(F.col(path)).alias("k")).distinct().withColumn("b", F.lit(True))
    a, b = F.col("a").isNotNull(), F.col("b").isNotNull()
    sides = own.join(there, "k", "full").agg(F.count_if(a).alias("in_table"), F.count_if(b).alias("in_folder"), F.count_if(a & ~b).alias("only_in_table"), F.count_if(b & ~a).alias("only_in_folder"))
    sides = sides.select(F.explode(F.create_map(*[x for c in sides.columns for x in (F.lit(c), F.col(c))])).alias("item", "n"))
    many = files_per_id(df, id_, name).select(F.col("n_files").cast("string").alias("item"), F.col("n_ids").alias("n"))
    out = [x.select(F.lit(s).alias("section"), "item", "n") for s, x in (("figures", figures), ("figures", plain), ("names", sides), ("files_per_id", many))]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def worst_corners(boxes: DataFrame) -> DataFrame:
    """page_no, max_xtl, max_ytl over its censor boxes, 0 without any."""
    c = F.col("label") == "censor"
    return boxes.groupBy("page_no").agg(F.coalesce(F.max(F.when(c, F.col("xtl"))), F.lit(0)).alias("max_xtl"), F.coalesce(F.max(F.when(c, F.col("ytl"))), F.lit(0)).alias("max_ytl"))


def resolution_qa(pages: DataFrame, corners: DataFrame, template_w: float, template_h: float) -> DataFrame:
    """page_no, ratio, redo, over: a page is redone when a worst corner lies beyond the template's side times its ratio to the
    scan's, on either axis; over: a ratio above 1.5.

    pages: page_no, width, height of the scans. The ratio shown is the larger of both axes.
    """
    x, y = F.lit(float(template_w)) / F.col("width"), F.lit(float(template_h)) / F.col("height")
    ratio = F.greatest(x, y)
    redo = (F.col("max_xtl") > F.lit(float(template_w)) * x) | (F.col("max_ytl") > F.lit(float(template_h)) * y)
    return pages.join(corners, "page_no").select("page_no", F.round(ratio, 6).alias("ratio"), redo.alias("redo"), (ratio > 1.5).alias("over"))


def qa_totals(qa: DataFrame) -> DataFrame:
    return qa.agg(F.count_if("redo").alias("pages_to_redo"), F.count_if("over").alias("ratios_over"), F.count("*").alias("n_pages"))
