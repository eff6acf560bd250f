"""Text similarity and numbers in recognised text."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def normalise(c: Column, nfkc: bool = False) -> Column:
    """Lower case; other than letters, digits, white space and . , : ; - ( ) / % becomes a blank; blanks run together.

    nfkc first brings compatibility forms together; in Python, so only where texts may hold any.
    """
    c = _nfkc(c) if nfkc else c
    kept = F.regexp_replace(F.lower(c), r"(?U)[^\p{L}\p{N}_\s.,:;()/%-]", " ")
    return F.trim(F.regexp_replace(kept, r"(?U)\s+", " "))


def tokens(c: Column) -> Column:
    """The distinct blank-separated tokens; none of an empty text."""
    return F.array_distinct(F.filter(F.split(c, " "), lambda t: t != ""))


def overlap_pairs(a: DataFrame, b: DataFrame, a_id: str, b_id: str, a_text: str = "text", b_text: str = "text") -> DataFrame:
    """a_id, b_id, na, nb, both: pairs of texts with tokens in common; by an index of tokens, not of pairs.

    The counts per pair are summed in the map tasks after the join on a token. A frequent token joins many texts: that is the
    size of the result, as any common token makes a pair.
    """
    each = lambda d, i, t, n: d.select(F.col(i), tokens(normalise(F.col(t))).alias("__t")).select(i, F.size("__t").cast("long").alias(n), F.explode("__t").alias("token"))
    x, y = each(a, a_id, a_text, "na"), each(b, b_id, b_text, "nb")
    return x.join(y, "token").groupBy(a_id, b_id, "na", "nb").agg(F.count("*").alias("both"))


def jaccard(both: Column, na: Column, nb: Column) -> Column:
    """Two empty sets are alike, one empty one is not."""
    return F.when((na == 0) & (nb == 0), F.lit(1.0)).when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(both / (na + nb - both))


def containment(both: Column, na: Column, nb: Column) -> Column:
    """In the smaller set; empty sets as for jaccard."""
    return F.when((na == 0) & (nb == 0), F.lit(1.0)).when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(both / F.least(na, nb))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matched characters by all characters, by the standard library's matcher; null counts as empty."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)], dtype=float)


def compare(a: Column, b: Column) -> Column:
    """Both texts normalised, their token counts, and three similarities."""
    x, y = normalise(F.coalesce(a, F.lit(""))), normalise(F.coalesce(b, F.lit("")))
    tx, ty = tokens(x), tokens(y)
    both, na, nb = F.size(F.array_intersect(tx, ty)), F.size(tx), F.size(ty)
    return F.struct(x.alias("a"), y.alias("b"), na.alias("na"), nb.alias("nb"), jaccard(both, na, nb).alias("jaccard"), containment(both, na, nb).alias("containment"), sequence_ratio(x, y).alias("sequence"))


def longest_digits(c: Column) -> Column:
    """The longest run of digits, the first of equal ones; null without any."""
    runs = F.regexp_extract_all(c, F.lit(r"([0-9]+)"), F.lit(1))
    keyed = F.transform(runs, lambda r, i: F.struct((-F.length(r)).alias("k"), i.alias("i"), r.alias("r")))
    return F.array_min(keyed)["r"]


def numeric_target(c: Column) -> Column:
    """Six digits and, after white space or none, a seventh, without blanks; else the longest run of digits; else null."""
    found = F.regexp_extract(c, r"([0-9]{6}\s*[0-9])", 1)
    return F.coalesce(F.when(found != "", F.replace(found, F.lit(" "), F.lit(""))), longest_digits(c))


def numeric_tokens(ocr: DataFrame, least: float = 50.0) -> DataFrame:
    """Recognised tokens of digits only, with more confidence than `least`."""
    return ocr.filter(F.col("text").rlike(r"^[0-9]+$") & (F.col("conf") > least))


def special_id(ocr: DataFrame, id_: str = "page_no") -> DataFrame:
    """special_id of each page of positioned tokens (pos, text, left, top, width): the first token of six digits with the
    single digit nearest to its right; else the first of seven digits other than 1234567."""
    six = ocr.filter(F.col("text").rlike("^[0-9]{6}$")).select(F.col(id_), F.col("pos").alias("p"), F.col("text").alias("t"), (F.col("left") + F.col("width")).alias("end"), F.col("left").alias("l"), F.col("top").alias("y"))
    one = ocr.filter(F.col("text").rlike("^[0-9]$")).select(F.col(id_).alias("__i"), F.col("pos").alias("q"), F.col("text").alias("d"), F.col("left").alias("x"), F.col("top").alias("z"))
    far = F.sqrt(F.pow(F.col("x") - F.col("l"), 2) + F.pow(F.col("z") - F.col("y"), 2))
    # a page's six-digit tokens are few
    near = six.join(one, (F.col(id_) == F.col("__i")) & (F.col("x") > F.col("l"))).groupBy(id_, "p", "t").agg(F.min(F.struct(far.alias("far"), "q", "d"))["d"].alias("d"))
    first = near.groupBy(id_).agg(F.min(F.struct("p", F.concat("t", "d").alias("v")))["v"].alias("a"))
    seven = ocr.filter(F.col("text").rlike("^[0-9]{7}$") & (F.col("text") != "1234567")).groupBy(id_).agg(F.min(F.struct("pos", "text"))["text"].alias("b"))
    return ocr.select(id_).distinct().join(first, id_, "left").join(seven, id_, "left").select(id_, F.coalesce("a", "b").alias("special_id"))


def page_of_path(c: Column) -> Column:
    """The number in .../page_<n>.png; null elsewhere."""
    return F.regexp_extract(c, r"page_([0-9]+)[.]png$", 1).try_cast("int")
