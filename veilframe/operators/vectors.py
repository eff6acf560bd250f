"""Packed hashes and feature vectors: distances, nearest neighbours, correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_bits(v: Column) -> Column:
    """64 bits of a vector of 64: whether each value exceeds the median of all but the first; the first is the highest bit."""
    bit = lambda x, m: F.when(x > m, F.lit(1)).otherwise(F.lit(0)).cast("long")
    return let(F.element_at(F.array_sort(F.slice(v, 2, 63)), 32), lambda m: F.aggregate(v, F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, 1).bitwiseOR(bit(x, m))))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)).cast("long")


def cost_matrix(pages: DataFrame, templates: DataFrame, key: str = "subject_id") -> DataFrame:
    """key, page_no, template_no, cost for pages (page_no, bits) and templates (template_no, bits) of the same key.

    An equi join on the key; a subject's templates are a few dozen at most.
    """
    t = templates.select(F.col(key).alias("__k"), "template_no", F.col("bits").alias("tbits"))
    return pages.join(t, F.col(key) == F.col("__k")).select(key, "page_no", "template_no", hamming(F.col("bits"), F.col("tbits")).alias("cost"))


def best_and_second(costs: DataFrame, key: str = "subject_id") -> DataFrame:
    """Best and second-best cost of each page and their gap; against 10^9 where there is one template."""
    two = F.slice(F.array_sort(F.collect_list("cost")), 1, 2)
    x = costs.groupBy(key, "page_no").agg(two.alias("c"))
    second = F.coalesce(F.get("c", F.lit(1)), F.lit(10**9).cast("long"))
    return x.select(key, "page_no", F.get("c", F.lit(0)).alias("best"), second.alias("second"), (second - F.get("c", F.lit(0))).alias("gap"))


def mutual_nearest(costs: DataFrame, key: str = "subject_id") -> DataFrame:
    """Pairs that are each other's cheapest; the lower number of equal ones."""
    by_page, by_template = Window.partitionBy(key, "page_no").orderBy("cost", "template_no"), Window.partitionBy(key, "template_no").orderBy("cost", "page_no")
    return costs.withColumn("r", F.row_number().over(by_page)).withColumn("s", F.row_number().over(by_template)).filter("r = 1 AND s = 1").drop("r", "s")


def nearest(costs: DataFrame, k: int = 2, key: str = "subject_id") -> DataFrame:
    """The k cheapest templates of each page, with their place."""
    w = Window.partitionBy(key, "page_no").orderBy("cost", "template_no")
    return costs.withColumn("place", F.row_number().over(w).cast("long")).filter(F.col("place") <= k)


def ratio_test(costs: DataFrame, ratio: float = 0.7, key: str = "subject_id") -> DataFrame:
    """Pages whose cheapest template costs less than ratio times the second one."""
    x = nearest(costs, 2, key).groupBy(key, "page_no").agg(F.min_by("template_no", "place").alias("template_no"), F.min("cost").alias("cost"), F.max("cost").alias("second"), F.count("*").alias("n"))
    return x.filter((F.col("n") == 2) & (F.col("cost") < F.lit(ratio) * F.col("second"))).drop("n")


def best_template(counts: DataFrame, key: list[str], template: str = "template", pos: str = "pos", n: str = "n_good") -> DataFrame:
    """key, template, n: the template with the most good matches, the first in order of pos among equals; null and 0 without any.

    One row a key and task is kept while it is summed, so a key with many templates is no burden.
    """
    best = F.max(F.struct(F.col(n).alias("n"), (-F.col(pos)).alias("p"), F.col(template).alias("t"))).alias("best")
    some = F.col("best.n") > 0
    return counts.groupBy(*key).agg(best).select(*key, F.when(some, F.col("best.t")).alias(template), F.coalesce(F.when(some, F.col("best.n")), F.lit(0)).cast("long").alias(n))


def best_n(costs: DataFrame, n: int = 50, key: str = "subject_id") -> DataFrame:
    """The n cheapest pairs of each key, with their place."""
    w = Window.partitionBy(key).orderBy("cost", "page_no", "template_no")
    return costs.withColumn("place", F.row_number().over(w).cast("long")).filter(F.col("place") <= n)


def bit_slice_candidates(a: DataFrame, b: DataFrame, slices: int = 4, width: int = 16) -> DataFrame:
    """a_id, b_id: pairs of packed hashes that agree on one slice at least; all pairs closer than `slices` bits are among them."""
    cut = F.array(*[F.struct(F.lit(i).alias("i"), F.shiftright(F.col("bits"), i * width).bitwiseAND(F.lit((1 << width) - 1)).alias("v")) for i in range(slices)])
    x, y = a.select("a_id", F.explode(cut).alias("s")), b.select("b_id", F.explode(cut).alias("s"))
    return x.join(y, "s").select("a_id", "b_id").distinct()


def let(value: Column, body) -> Column:
    """body of a value that is worked out once per row, however often it stands in body."""
    return F.transform(F.array(value), body)[0]


def _sum(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def _centred(v: Column) -> Column:
    doubles = F.transform(v, lambda e: e.cast("double"))
    return let(doubles, lambda x: let(_sum(x) / F.size(x), lambda m: F.transform(x, lambda e: e - m)))


def z_score(v: Column, least: float = 1e-6) -> Column:
    """(x - mean) / standard deviation; divided by 1 where that is under `least`."""
    sd = lambda d: F.sqrt(_sum(F.transform(d, lambda e: e * e)) / F.size(d))
    return let(_centred(v), lambda d: let(sd(d), lambda s: F.transform(d, lambda e: e / F.when(s < least, F.lit(1.0)).otherwise(s))))


def correlation(a: Column, b: Column, eps: float = 1e-6) -> Column:
    """Normalised cross-correlation of vectors of equal length, eps in the denominator."""
    sq = lambda v: _sum(F.transform(v, lambda e: e * e))
    return let(_centred(a), lambda x: let(_centred(b), lambda y: _sum(F.zip_with(x, y, lambda p, q: p * q)) / (F.sqrt(sq(x)) * F.sqrt(sq(y)) + F.lit(eps))))


def cropped_correlation(a: Column, b: Column) -> Column:
    """Of the middle parts of both vectors, as long as the shorter one."""
    n = F.least(F.size(a), F.size(b))
    cut = lambda v: F.slice(v, F.floor((F.size(v) - n) / 2).cast("int") + 1, n)
    return correlation(cut(a), cut(b))


def black_change(found: Column, expected: Column) -> Column:
    return (found - expected) / (expected + F.lit(1e-10))
