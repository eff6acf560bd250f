"""Assigning pages to templates at the least total cost, and how sure that is."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.operators.vectors import best_and_second


def solve(cost: np.ndarray) -> list[tuple[int, int]]:
    """Row and column pairs of least total cost, as many as the shorter side; by shortest augmenting paths with potentials.

    Rows come in order. Which pairing of equal cost is taken depends on the order of rows and columns alone.
    """
    cost = np.asarray(cost, float)
    if cost.size == 0:
        return []
    if cost.shape[0] > cost.shape[1]:
        return sorted((r, c) for c, r in solve(cost.T))
    n, m = cost.shape
    u, v, owner = np.zeros(n), np.zeros(m), np.full(m, -1)
    for start in range(n):
        reach, come, done, row, at = np.full(m, np.inf), np.full(m, -1), np.zeros(m, bool), start, -1
        while True:
            slack = np.where(done, np.inf, cost[row] - u[row] - v + (reach[at] if at >= 0 else 0.0))
            better = slack < reach - 1e-12
            reach[better], come[better] = slack[better], at
            at = int(np.argmin(np.where(done, np.inf, reach)))
            done[at] = True
            if owner[at] < 0:
                break
            row = owner[at]
        end = reach[at]
        u[start] += end
        seen = done & (owner >= 0)
        u[owner[seen]] += end - reach[seen]
        v[done] -= end - reach[done]
        while at >= 0:
            prev = come[at]
            owner[at] = owner[prev] if prev >= 0 else start
            at = prev
    return sorted((int(r), c) for c, r in enumerate(owner) if r >= 0)


def assign(costs: DataFrame, key: str = "subject_id") -> DataFrame:
    """key, page_no, template_no, cost: each subject's pages and templates paired; what is left over of the longer side isn't.

    A grouped map: a subject has a few dozen pages and templates. Missing pairs cost more than all others together.
    """
    kind = costs.schema[key].dataType.simpleString()

    def run(group: pd.DataFrame) -> pd.DataFrame:
        table = group.pivot_table(index="page_no", columns="template_no", values="cost", aggfunc="min")
        full = table.to_numpy(float)
        missing = np.isnan(full)
        full = np.where(missing, np.nansum(np.abs(full)) + 1, full)
        pairs = [(r, c) for r, c in solve(full) if not missing[r, c]]
        return pd.DataFrame({key: [group[key].iloc[0]] * len(pairs), "page_no": [table.index[r] for r, _ in pairs], "template_no": [table.columns[c] for _, c in pairs], "cost": [float(full[r, c]) for r, c in pairs]})

    return costs.select(key, F.col("page_no").cast("long"), F.col("template_no").cast("long"), F.col("cost").cast("double")).groupBy(key).applyInPandas(run, f"{key} {kind}, page_no long, template_no long, cost double")


def report(costs: DataFrame, chosen: DataFrame, gap: float = 5, most: float = 18, key: str = "subject_id", integer_costs: bool = False) -> DataFrame:
    """Per matched page: best, second, gap, chosen and ok (the gap is wide enough, the cost low enough).

    integer_costs cuts fractions off first, as some readers of such reports do: no text similarity is then ever sure.
    """
    c = F.col("cost").cast("long") if integer_costs else F.col("cost")
    rows = best_and_second(costs.withColumn("cost", c), key)
    x = chosen.select(key, "page_no", "template_no", c.alias("chosen")).join(rows, [key, "page_no"])
    return x.withColumn("ok", (F.col("gap") >= gap) & (F.col("chosen") <= most))


def summary(rows: DataFrame, key: str = "subject_id") -> DataFrame:
    """Per subject: total and average cost, matches, and whether all rows are ok."""
    return rows.groupBy(key).agg(F.sum("chosen").alias("total_cost"), F.avg("chosen").alias("avg_cost"), F.count("*").alias("num_matches"), F.bool_and("ok").alias("is_confident"))


def text_costs(similarities: DataFrame, similarity: str = "similarity") -> DataFrame:
    return similarities.withColumn("cost", 1 - F.col(similarity)).drop(similarity)


def disagreeing(a: DataFrame, b: DataFrame, key: str = "subject_id") -> DataFrame:
    """Pages that two methods match to different templates, or only one of them matches."""
    x = a.select(key, "page_no", F.col("template_no").alias("a")).join(b.select(key, "page_no", F.col("template_no").alias("b")), [key, "page_no"], "full")
    return x.filter(~F.col("a").eqNullSafe(F.col("b")))


def with_match(pages: DataFrame, matches: DataFrame, name: str, key: str = "subject_id") -> DataFrame:
    """pages with the template and cost one method found: <name>_template, <name>_cost."""
    m = matches.select(key, "page_no", F.col("template_no").alias(f"{name}_template"), F.col("cost").alias(f"{name}_cost"))
    return pages.join(m, [key, "page_no"], "left")


def region_check(regions: DataFrame, least: int = 2, key: str = "subject_id") -> DataFrame:
    """Pairs of page and template with enough matched regions, and all their confidences in order."""
    return regions.groupBy(key, "page_no", "template_no").agg(F.count_if("matched").alias("n_matched"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "confidence"))), lambda x: x["confidence"]).alias("confidences")).withColumn("matched", F.col("n_matched") >= least)


def variant(totals: DataFrame, key: str = "subject_id") -> DataFrame:
    """The template variant of least total cost per subject, the first of equal ones; totals: key, variant, pos, cost."""
    return totals.groupBy(key).agg(F.min_by("variant", F.struct("cost", "pos")).alias("variant"))
