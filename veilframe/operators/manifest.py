"""Manifests: one row for each file of a subject. Cleaning, lookups, reconciliation with listings, sampling, shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def strip_last_suffix(c: Column) -> Column:
    """The text up to its last dot; all of it without one."""
    return F.regexp_replace(c, r"[.][^.]*$", "")


def strip_first_suffix(c: Column) -> Column:
    """The text up to its first dot."""
    return F.substring_index(c, ".", 1)


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows without a null in any column, or in those named."""
    return df.na.drop("any", subset=subset)


def ambiguous_names(df: DataFrame, name: str = "object_name", id_: str = "subject_id") -> DataFrame:
    """Names that stand for more than one id, and for how many."""
    return df.groupBy(name).agg(F.countDistinct(id_).alias("n_ids")).filter("n_ids > 1")


def without_ambiguous(df: DataFrame, name: str = "object_name", id_: str = "subject_id") -> DataFrame:
    """Rows whose name stands for one id. One pass by a window's extremes would shuffle all rows; the anti join is on few names."""
    return df.join(ambiguous_names(df, name, id_).select(name), name, "left_anti")


def prepare(df: DataFrame, name: str = "object_name", id_: str = "subject_id") -> DataFrame:
    """A manifest ready for work: no nulls, names without suffix, no ambiguous name, no repeated row, and empty outcome columns.

    The suffix goes first, so that ambiguity and repetition are judged on what is left. Ordered by id, then name.
    """
    x = drop_null_rows(df.select(id_, name)).withColumn(name, strip_last_suffix(F.col(name)))
    x = without_ambiguous(x, name, id_).dropDuplicates()
    return x.select(id_, name, F.lit(False).alias("used"), F.lit("").alias("warning_ordering"), F.lit("").alias("warning_censoring")).orderBy(id_, name)


def last_id_of_name(df: DataFrame, name: str = "object_name", id_: str = "subject_id", pos: str = "ingest_pos") -> DataFrame:
    """A lookup in which the last row of a name wins."""
    return df.filter(F.col(name).isNotNull()).groupBy(name).agg(F.max_by(id_, pos).alias(id_))


def remaining(df: DataFrame, ids: DataFrame | None = None, id_: str = "subject_id") -> DataFrame:
    """Rows not used yet, of the ids given."""
    x = df.filter(~F.col("used"))
    return x if ids is None else x.join(ids.select(id_).distinct(), id_, "left_semi")


def mark_used(df: DataFrame, done: DataFrame, id_: str = "subject_id") -> DataFrame:
    """used, true also for the ids done; never back to false."""
    ids = done.select(F.col(id_).alias("__done")).distinct()
    return df.join(ids, F.col(id_) == F.col("__done"), "left").withColumn("used", F.col("used") | F.col("__done").isNotNull()).drop("__done")


def sample_ids(df: DataFrame, n: int, seed: int, id_: str = "subject_id") -> DataFrame:
    """All rows of n ids, the same for a seed: those with the least digests of seed and id. Null ids aren't drawn."""
    drawn = F.md5(F.concat(F.lit(f"{seed}/"), F.col(id_).cast("string")).cast("binary"))
    ids = df.select(id_).filter(F.col(id_).isNotNull()).distinct().orderBy(drawn, id_).limit(n)
    return df.join(ids, id_, "left_semi")


def ends_with(c: Column, suffix: str) -> Column:
    return F.coalesce(c.endswith(suffix), F.lit(False))


def holds(c: Column, part: str) -> Column:
    return F.coalesce(c.contains(part), F.lit(False))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return strip_last_suffix(basename(path))


def page_number(path: Column, strict: bool = False) -> Column:
    """The number after the last _ of a path's stem; null, or an error if strict, where that is no number."""
    last = F.element_at(F.split(stem(path), "_"), -1)
    n = last.try_cast("int")
    return n if not strict else F.coalesce(n, F.raise_error(F.concat(F.lit("no page number in "), path)).cast("int"))


def nth_file(files: DataFrame, wanted: DataFrame, path: str = "path", page: str = "page_no") -> DataFrame:
    """For each wanted page the file at that place in the order of page numbers; null beyond the last."""
    ranked = files.select(F.col(path), F.row_number().over(Window.orderBy(page_number(F.col(path)), path)).cast("long").alias("__n"))
    return wanted.join(ranked, F.col(page) == F.col("__n"), "left").drop("__n")


def template_names(questionnaire: Column) -> Column:
    """Templates of a questionnaire 1 to 13: two versions of the first and the eighth, one of the others; null beyond."""
    q = F.concat(F.lit("q_"), questionnaire.cast("string"))
    two = questionnaire.isin(1, 8)
    return F.when(questionnaire.between(1, 13), F.when(two, F.array(q, F.concat(q, F.lit("v2")))).otherwise(F.array(q)))


def resolve_files(names: DataFrame, listing: DataFrame, name: str = "object_name") -> DataFrame:
    """path: <name>.pdf if listed, else <name>.tif.pdf if listed, else null."""
    paths = listing.select("path").distinct()
    a, b = paths.withColumnRenamed("path", "__a"), paths.withColumnRenamed("path", "__b")
    x = names.join(a, F.concat(F.col(name), F.lit(".pdf")) == F.col("__a"), "left").join(b, F.concat(F.col(name), F.lit(".tif.pdf")) == F.col("__b"), "left")
    return x.withColumn("path", F.coalesce("__a", "__b")).drop("__a", "__b")


def existence(names: DataFrame, listing: DataFrame, name: str = "object_name") -> DataFrame:
    """How many of the names there are, and how many exist."""
    x = names.join(listing.select(F.col("path").alias("__p")).distinct(), F.col(name) == F.col("__p"), "left")
    return x.agg(F.count("*").alias("listed"), F.count("__p").alias("present"))


def differences(a: DataFrame, b: DataFrame, key: str, examples: int = 3) -> DataFrame:
    """side, n, examples: keys only in a and only in b, with the first few in order."""
    a, b = a.select(key).filter(F.col(key).isNotNull()).distinct(), b.select(key).filter(F.col(key).isNotNull()).distinct()
    only = a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))
    ranked = only.withColumn("r", F.row_number().over(Window.partitionBy("side").orderBy(key))).filter(F.col("r") <= examples)
    few = ranked.groupBy("side").agg(F.concat_ws(",", F.sort_array(F.collect_list(key))).alias("examples"))
    return only.groupBy("side").agg(F.count("*").alias("n")).join(few, "side")


def union_differences(sets: list[DataFrame], table: DataFrame, key: str) -> DataFrame:
    """The differences of the union of several id sets and a table's ids."""
    every = sets[0].select(key)
    for s in sets[1:]:
        every = every.unionByName(s.select(key))
    return differences(every, table, key)


def names_match(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """missing (in b), extra (in b) as sorted lists, and same: whether the two name sets are equal."""
    x = a.select(F.col(name).alias("a")).distinct().join(b.select(F.col(name).alias("b")).distinct(), F.col("a") == F.col("b"), "full")
    return x.agg(F.sort_array(F.collect_list(F.when(F.col("b").isNull(), F.col("a")))).alias("missing"), F.sort_array(F.collect_list(F.when(F.col("a").isNull(), F.col("b")))).alias("extra")).withColumn("same", (F.size("missing") == 0) & (F.size("extra") == 0))


def contiguous_shard(df: DataFrame, shards: int, key: str) -> DataFrame:
    """shard: runs of n // shards keys in order, the last one with the rest; the last for all if there are fewer keys.

    The rank comes from counts of ranges of keys, summed, and a rank within the range: no task sees all keys.
    """
    ranked = global_rank(df.select(key).distinct(), key)
    n = F.lit(ranked.count())
    size = F.floor(n / shards)
    shard = F.when(size == 0, F.lit(shards - 1)).otherwise(F.least(F.floor((F.col("rank") - 1) / size), F.lit(shards - 1)))
    return df.join(ranked.select(key, shard.cast("long").alias("shard")), key)


def strided_shard(df: DataFrame, shards: int, key: str) -> DataFrame:
    """shard: places in order of the key, dealt in turn."""
    ranked = global_rank(df.select(key).distinct(), key)
    return df.join(ranked.select(key, F.pmod(F.col("rank") - 1, F.lit(shards)).cast("long").alias("shard")), key)


def global_rank(keys: DataFrame, key: str, parts: int = 64) -> DataFrame:
    """rank from 1 on in order of distinct keys, by ranges: a sum over the ranges' counts, and a rank in each."""
    ranged = keys.repartitionByRange(parts, key).withColumn("__part", F.spark_partition_id())
    ranged = ranged.persist()
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("__part").count().select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(key))
    return ranged.withColumn("__place", place).join(F.broadcast(starts), "__part").select(key, (F.col("__start") + F.col("__place")).cast("long").alias("rank"))
