"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source gets target / size copies on average. The whole part is certain; the fractional part is rounded by the
pivotal method, with words as the mass: two fractional documents of a source meet, one random transfer of words from one to
the other makes one of them whole (0 or 1 copy more), the other meets the next. So the words of a source never change by more
than what a last fractional document brings, and each document keeps its expected copies.

Blocks of a source are reduced on their own, each to one fractional document at most; these meet in blocks of blocks, and so
on: a reduction tree whose depth is the logarithm of the largest source's blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm.common import Scratch, fresh, text_of

#: A word for the size of a text: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a block of the reduction tree's leaves, about; residuals of a block above.
LEAF, FAN = 4096, 256
#: Whole within rounding errors.
EPS = 1e-12


def size_of(text: str | Column) -> Column:
    """Words of a text; null counts as empty."""
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """From source, source_size: adds target.

    Sources by code point, null last, take the weights in turn and share `share` times all sizes in proportion. A target stops
    at `most` times its source's size and the excess goes to the others by weight: target = min(level * weight, most * size)
    with one level for all, found in closed form from running sums over the sources in order of most * size / weight.
    Sources without words get 0. One row for each source; the running sums take all of them in one task.
    """
    # a binary key sorts by code point; the sources are few against the documents
    turn = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(F.row_number().over(turn) - 1, F.lit(len(weights))) + 1).cast("int"))
    by = Window.orderBy("ratio", F.col("source").isNull(), F.col("source").cast("binary"))
    every = Window.partitionBy(F.lit(0))
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    x = sizes.withColumn("weight", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    x = x.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    x = x.withColumn("level", (F.lit(float(share)) * F.sum("source_size").over(every) - F.col("capped")) / F.col("left"))
    # the level is that of the first source that it doesn't cap; with none, all are capped
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(every)
    return x.withColumn("target", F.least(F.coalesce(level["level"] * F.col("weight"), F.col("cap")), F.col("cap"))).select("source", "source_size", "target")


def _draws(seed: str, n: int) -> np.ndarray:
    return np.random.default_rng(int.from_bytes(hashlib.sha256(seed.encode()).digest()[:8], "little")).random(n)


def pivot(mass: list[float], part: list[float], seed: str) -> list[float]:
    """Rounds fractional parts of units of the given masses until one unit at most is fractional; the masses' sum weighted by
    the parts stays, and each part's expectation."""
    draws, out, open_ = _draws(seed, len(part)).tolist(), list(part), -1
    for k in range(len(out)):
        if not EPS < out[k] < 1 - EPS:
            out[k] = round(out[k])
            continue
        if mass[k] <= 0:
            out[k] = float(draws[k] < out[k])
            continue
        if open_ < 0:
            open_ = k
            continue
        a, b, x, y = mass[open_], mass[k], out[open_], out[k]
        up = min((1 - x) * a, y * b)  # words that the first may take from the second
        down = min(x * a, (1 - y) * b)
        moved = up if draws[k] < down / (up + down) else -down
        x, y = x + moved / a, y - moved / b
        out[open_], out[k] = x, y
        first, second = EPS < x < 1 - EPS, EPS < y < 1 - EPS
        if not first:
            out[open_] = float(round(x))
            open_ = k if second else -1
        if not second:
            out[k] = float(round(y))
    return out


def _level(units: DataFrame, fan: int, seed: int, last: bool) -> DataFrame:
    """One level of the tree over source, block, u (order within the source), mass, part, with the key columns of `units`."""
    schema = units.schema

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["u", "id", "key"], kind="stable", na_position="first")
        source, block = group["source"].iloc[0], int(group["block"].iloc[0])
        name = f"{seed}|{fan}|{source!r}|{block}"
        parts = pivot(group["mass"].tolist(), group["part"].tolist(), name)
        if last:  # the one that is left has nothing to meet
            parts = [p if p in (0.0, 1.0) else float(r < p) for p, r in zip(parts, _draws(name + "|end", len(parts)), strict=True)]
        return group.assign(part=parts, block=block // FAN)

    return units.groupBy("source", "block").applyInPandas(run, schema)


def _open(c: str = "part") -> Column:
    return (F.col(c) > 0) & (F.col(c) < 1)


def decide(units: DataFrame, scratch: Scratch, seed: int = 0) -> DataFrame:
    """Copies for each unit of: source, id, key, rows (that share the unit), size, source_size, target.

    Returns id, key, source, copies. A unit is what rows with equal source, id and key share; its mass is rows * size.
    """
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    u = F.xxhash64(F.lit(seed), F.col("id"), F.col("key"))
    counted = units.groupBy("source").agg(F.count("*").alias("units"))
    x = units.join(counted.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    blocks = F.ceil(F.col("units") / LEAF)
    x = x.select("source", F.pmod(u, blocks).cast("long").alias("block"), u.alias("u"), F.col("id").cast("string").alias("id"), "key", F.floor(rate).cast("long").alias("whole"), (F.col("rows") * F.col("size")).cast("double").alias("mass"), (rate - F.floor(rate)).alias("part"))
    most = counted.agg(F.max("units")).first()[0] or 0
    width, done, level = max(1, -(-most // LEAF)), [], 0
    while True:
        last = width == 1
        x = scratch.keep(_level(x, level, seed, last))
        if last:
            done.append(x)
            break
        done.append(x.filter(~_open()))
        x = x.filter(_open())
        width, level = -(-width // FAN), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    # ids went through pandas as texts, which keep nulls and all digits
    return out.select("source", F.col("id").cast("long").alias("id"), "key", (F.col("whole") + F.round("part").cast("long")).alias("copies"))


def mix(df: DataFrame, scratch: Scratch, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Decides how often the mix takes each row: source, id, key (hash of the text), size, source_size, target, copies.

    One row for each distinct (source, id, text); rows that repeat one share its decision. Null text is empty, of size 0, and
    gets its whole copies or one by chance. Null sources are one source, the last. Null ids are ids of their own. The same
    rows give the same result, in whatever order or partitions. Targets come from all rows.
    """
    rows = df.select(F.col(source).cast("string").alias("source"), F.col(doc_id).cast("long").alias("id"), F.xxhash64(text_of(text)).alias("key"), size_of(text).alias("size"))
    units = scratch.keep(rows.groupBy("source", "id", "key").agg(F.count("*").alias("rows"), F.max("size").alias("size")))
    sums = units.groupBy("source").agg(F.sum(F.col("rows") * F.col("size")).alias("source_size"))
    goal = targets(sums, weights, share, most).withColumnRenamed("source", "s")
    full = units.join(F.broadcast(goal) if goal.count() <= 100_000 else goal, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    full = scratch.keep(full)
    copies = decide(full, scratch, seed).select(F.col("source").alias("s"), F.col("id").alias("i"), F.col("key").alias("k"), "copies")
    same = F.col("key").eqNullSafe(F.col("k")) & F.col("id").eqNullSafe(F.col("i")) & F.col("source").eqNullSafe(F.col("s"))
    return full.join(copies, same).drop("s", "i", "k")


def taken(df: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted): one row for each row of df."""
    out = mix(df, Scratch(df.sparkSession, "mix"), seed=seed)
    rows = F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int")))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), rows.alias("_r")).drop("_r")


def apply_mix(df: DataFrame, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """df's rows, each as often as the mix takes it, with df's columns."""
    out = mix(df, Scratch(df.sparkSession, "mix"), seed=seed, doc_id=doc_id, text=text, source=source)
    i, k, name, n, key, copy = (fresh(df, x) for x in ("i", "k", "s", "n", "key", "copy"))
    wanted = out.filter("copies > 0").select(F.col("id").alias(i), F.col("key").alias(k), F.col("source").alias(name), F.col("copies").cast("int").alias(n))
    keyed = df.withColumn(key, F.xxhash64(text_of(text)))
    same = (F.col(key) == F.col(k)) & F.col(doc_id).cast("long").eqNullSafe(F.col(i)) & F.col(source).cast("string").eqNullSafe(F.col(name))
    return keyed.join(wanted, same).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*[F.col(f"`{c}`") for c in df.columns])
