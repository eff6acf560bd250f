"""SpotSigs: fingerprints from the content words that follow common words.

Common words (anchors) stand where prose is; a signature is an anchor and the chain of the next CHAIN content words. A text's
fingerprint is the set of its signatures, so menus and lists hardly show in it. Near duplicates are found among texts of
similar set sizes: sizes fall into classes such that a Jaccard of the threshold only joins neighbouring classes, and in a
class a text offers only the rarest signatures that a partner must share one of. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm.common import Scratch, text_of

#: Fixed list: common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was were which will with you "
    "als am auch auf aus bei das dass dem den der des die durch ein eine einem einen einer eines es für hat ich im ist mit nicht noch nur oder sich sie sind so über um und von vor war wie wir zu zum zur "
    "au aux avec ce ces cette dans de du elle en est et eux il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui sa se ses son sont sur un une vous "
    "al algo como con cuando de del desde el ella ellos entre era es esta este está fue ha hasta la las lo los más me mi muy no nos o para pero por porque que se si sin sobre son su sus también un una uno y ya"
).split()
#: Content words of a chain, and words after an anchor that are looked at for them.
CHAIN, REACH = 2, 10


def words(text: Column) -> Column:
    """Runs of letters and digits, lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def signatures(w: Column, anchors: tuple[str, ...] = tuple(sorted(set(ANCHORS))), chain: int = CHAIN, reach: int = REACH) -> Column:
    """The set of a word array's signatures as sorted 64-bit hashes.

    A text without any full chain has its distinct words as signatures, so that short or odd texts compare too.
    """
    common = lambda x: x.isin(*anchors)

    def at(x: Column, i: Column) -> Column:
        follow = F.slice(F.filter(F.slice(w, i + 2, F.lit(reach)), lambda y: ~common(y)), 1, chain)
        return F.when(common(x), F.concat(F.array(x), follow))

    chains = F.filter(F.transform(w, at), lambda c: F.size(c) == chain + 1)
    found = F.array_sort(F.array_distinct(F.transform(chains, lambda c: F.xxhash64(c))))
    return F.when(F.size(found) > 0, found).otherwise(F.array_sort(F.array_distinct(F.transform(w, lambda x: F.xxhash64(x)))))


def text_form(sigs: Column) -> Column:
    """A fingerprint as text: its size, then its signatures in hexadecimal, sorted; equal for equal sets."""
    return F.concat(F.size(sigs).cast("string"), F.lit(":"), F.concat_ws(",", F.transform(sigs, lambda s: F.lower(F.hex(s)))))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets in arrays; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def fingerprint(df: DataFrame, text: str = "text", out: str = "sigs") -> DataFrame:
    """Adds the signatures of a text column; null text counts as empty, which has none. No shuffle."""
    # the words are a column of their own: lambdas read it again and again
    w = "__words"
    return df.withColumn(w, words(text_of(text))).withColumn(out, signatures(F.col(w))).drop(w)


def near_pairs(df: DataFrame, threshold: float = 0.8, key: str = "doc_id", sigs: str = "sigs") -> DataFrame:
    """a, b, similarity: links between texts whose fingerprints are alike by the threshold or more; and copies' first ids.

    Texts with equal fingerprints are one class, represented by the least key: pairs are between representatives, a < b, and
    the rest follows from `classes`. Empty fingerprints and null keys have no partner. Any partner shares one of the
    size - ceil(threshold * size) + 1 rarest signatures; only these are joined, within size classes. No pair is lost.
    """
    scratch = Scratch(df.sparkSession, "spots")  # the fingerprints are read several times over
    reps = scratch.keep(classes(scratch.keep(df.select(key, sigs)), key, sigs))
    one = reps.groupBy("fp").agg(F.min("rep").alias("id"), F.first("sigs").alias("sigs")).select("id", "sigs", F.size("sigs").alias("n"))
    each = one.select("id", "n", F.explode("sigs").alias("s"))
    rarity = each.groupBy("s").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = each.join(rarity, "s").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("shared"))
    # signatures that no other text has come first in the order of rarity and use up the prefix
    left = F.col("n") - F.ceil(F.col("n") * threshold) + 1 - (F.col("n") - F.size("shared"))
    prefix = ranked.filter(left > 0).select("id", "n", F.explode(F.transform(F.slice("shared", F.lit(1), left.cast("int")), lambda x: x["s"])).alias("s"))
    step = -F.log(F.lit(threshold))
    size_class = F.floor(F.log(F.col("n")) / step + 1e-9)
    probe = prefix.withColumn("c", size_class)
    stored = prefix.withColumn("c", F.explode(F.array(size_class - 1, size_class, size_class + 1)))
    a, b = probe.alias("a"), stored.alias("b")
    fits = (F.col("a.s") == F.col("b.s")) & (F.col("a.c") == F.col("b.c")) & (F.col("a.id") < F.col("b.id"))
    fits &= (F.least("a.n", "b.n") >= threshold * F.greatest("a.n", "b.n") - 1e-9)
    pairs = a.join(b, fits).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    left_, right = one.select(F.col("id").alias("a"), F.col("sigs").alias("sa")), one.select(F.col("id").alias("b"), F.col("sigs").alias("sb"))
    return pairs.join(left_, "a").join(right, "b").withColumn("similarity", jaccard(F.col("sa"), F.col("sb"))).filter(F.col("similarity") >= threshold - 1e-12).select("a", "b", "similarity")


def classes(df: DataFrame, key: str = "doc_id", sigs: str = "sigs") -> DataFrame:
    """key, rep, fp, sigs: the least key of the rows with an equal fingerprint, not empty."""
    keyed = df.filter(F.col(key).isNotNull() & (F.size(sigs) > 0)).select(F.col(key).alias("key"), F.col(sigs).alias("sigs")).withColumn("fp", F.md5(text_form(F.col("sigs"))))
    least = keyed.groupBy("fp").agg(F.min("key").alias("rep"))
    return keyed.join(least, "fp").select("key", "rep", "fp", "sigs")


#: Documents of a bucket of the ids' order, about; buckets that may be broadcast.
BUCKET, MOST_BUCKETS = 2_000, 100_000


def with_next(df: DataFrame, key: str = "doc_id", carried: tuple[str, ...] = ("text", "sigs")) -> DataFrame:
    """Adds next_<c> for the columns carried: those of the row after it in descending order of key; the first after the last.

    Null keys come last; rows of equal keys are ordered by a hash of their first column carried. One shuffle, by buckets of
    keys; the first rows of each bucket are also dealt to the bucket before it, so no task sees more than a bucket. Buckets
    have equal ranges of keys, or equal numbers of rows where that would be uneven.
    """
    n, low, high = df.agg(F.count(key), F.min(key), F.max(key)).first()
    count = max(1, -(-n // BUCKET))
    if n:
        width = max(1, -(-(high - low + 1) // count))
        bucket = F.floor((F.col(key) - F.lit(low)) / F.lit(width)).cast("long")
        worst = df.select(bucket.alias("b")).groupBy("b").count().agg(F.max("count")).first()[0]
        if worst > 8 * BUCKET:
            k = min(count, 4096)
            bounds = sorted(set(df.agg(F.percentile_approx(key, [i / k for i in range(1, k)] or [0.5], 100_000)).first()[0]))
            array = F.array(*[F.lit(int(b)).cast("long") for b in bounds])
            bucket = F.size(F.filter(array, lambda b: b <= F.col(key))).cast("long")
    else:
        bucket = F.lit(0).cast("long")
    bucket = F.coalesce(bucket, F.lit(-1).cast("long"))
    keys = df.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("k"), bucket.alias("b"))
    heads = keys.groupBy("b").agg(F.max("k").alias("head"))
    # the bucket that stands before each in descending order; before the first stands the last. A row for each bucket.
    heads = heads.withColumn("before", F.coalesce(F.lag("b").over(Window.orderBy(F.desc("b"))), F.min("b").over(Window.partitionBy(F.lit(0))))).withColumnRenamed("b", "hb")
    x = df.withColumn("__b", bucket).withColumn("__k", F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))))
    joined = x.join(F.broadcast(heads) if count <= MOST_BUCKETS else heads, F.col("__b") == F.col("hb"))
    deals = F.when(F.col("__k") == F.col("head"), F.array(F.struct(F.col("__b").alias("b"), F.lit(0).alias("guest")), F.struct(F.col("before").alias("b"), F.lit(1).alias("guest")))).otherwise(F.array(F.struct(F.col("__b").alias("b"), F.lit(0).alias("guest"))))
    dealt = joined.withColumn("__at", F.explode(deals)).drop("head", "before", "hb").withColumn("__in", F.col("__at.b")).withColumn("__guest", F.col("__at.guest")).drop("__at", "__b")
    order = Window.partitionBy("__in").orderBy("__guest", F.desc("__k"), F.xxhash64(carried[0]))
    for c in carried:
        dealt = dealt.withColumn(f"next_{c}", F.lead(c).over(order))
    return dealt.filter("__guest = 0").drop("__in", "__guest", "__k")


def edits(df: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: one row for each document.

    The edited text is the text with its last third replaced by the beginning of the next document's (descending doc_id).
    """
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    x = with_next(fingerprint(docs))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    x = x.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sigs", "next_sigs")
    x = fingerprint(x, "edited", "edited_sigs")
    sha = F.sha2(F.col("edited").cast("binary"), 256)
    return x.select(
        "doc_id", "n_chars", sha.alias("edited_sha256"), text_form(F.col("sigs")).alias("fingerprint"), text_form(F.col("edited_sigs")).alias("edited_fingerprint"),
        jaccard(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), jaccard(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )
