"""URL rules, and trust over the host graph for what no rule decides.

Trusted seeds are the hosts of pages that a rule allows, blocked seeds those of pages that a rule blocks, each in proportion to
such pages. Trust is a PageRank along links that restarts at trusted seeds, distrust one against the links' direction that
restarts at blocked seeds: who links to the blocked is near them. A host is blocked if its distrust exceeds `ratio` times
its trust. All of it is DataFrame operations; per host, not per page, once the links are counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Links of a page: the value of an attribute href or src that names another host.
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """verdict for urls of a host and its subdomains whose path starts with path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The query's rules.
RULES = (Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"), Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block"))


def host_of(url: str | Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; empty without :// or url."""
    c = F.col(url) if isinstance(url, str) else url
    return F.translate(F.coalesce(F.regexp_extract(c, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: str | Column) -> Column:
    """After the host up to ?, # or the end."""
    c = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(c, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null; block before allow at equal length. For up to a thousand rules."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block")):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame, html: str = "html") -> DataFrame:
    """src, dst, n: links between different hosts, counted; from pages with a host column and an html column (null: no links)."""
    links = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(LINK), F.lit(1))
    found = pages.select(F.col("host").alias("src"), F.explode(links).alias("link"))
    dst = host_of(F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link")))
    return found.select("src", dst.alias("dst")).filter("src != '' AND dst != '' AND src != dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def personal_rank(seeds: DataFrame, edges: DataFrame, scratch: Scratch, damping: float = 0.85, rounds: int | None = None, cut: int = 5, least: float = 1e-7) -> DataFrame:
    """host, rank: PageRank over src, dst, n that restarts at host, mass (summing to 1).

    What hosts without links hold isn't moved on; ranks are scaled to sum to 1 at the end. Without a number of rounds it goes
    on until `cut` rounds change less than `least` of all mass and reach no new host. Lineage is cut every `cut` rounds.
    """
    if edges.isEmpty():
        return seeds.select("host", F.col("mass").alias("rank"))
    out = edges.groupBy("src").agg(F.sum("n").alias("all"))
    steps = scratch.keep(edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("all")).alias("share")))
    rank = seeds.select("host", F.col("mass").alias("rank"))
    k, before = 0, None
    while rounds is None or k < rounds:
        moved = rank.join(steps, rank["host"] == steps["src"]).select(F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"))
        restart = seeds.select("host", (F.col("mass") * (1 - damping)).alias("rank"))
        rank = moved.unionByName(restart).groupBy("host").agg(F.sum("rank").alias("rank"))
        k += 1
        if k % cut == 0:
            rank = scratch.keep(rank)
            if rounds is None and before is not None:
                both = rank.join(before.withColumnRenamed("rank", "old"), "host", "left")
                change, new = both.agg(F.sum(F.abs(F.col("rank") - F.coalesce("old", F.lit(0.0)))), F.count_if(F.col("old").isNull())).first()
                if not new and (change or 0.0) <= least:
                    break
            before = rank
    rank = scratch.keep(rank)
    total = rank.agg(F.sum("rank")).first()[0] or 1.0
    return rank.withColumn("rank", F.col("rank") / F.lit(total))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, ratio: float = 1.0, damping: float = 0.85, rounds: int | None = None, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust: one row for each page.

    Where no rule fits, the host's verdict holds: block if distrust > ratio * trust, else allow; so a host that neither
    reaches is allowed. Null or malformed urls have an empty host and path, no trust, no rule, and are allowed. Links of equal
    pages all count. trust and distrust are 0 for hosts that no mass reaches.
    """
    scratch = Scratch(pages.sparkSession, "hosts")
    named = pages.select(F.col(page_id).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), F.col(html).alias("html"))
    rule, verdict = match(F.col("host"), F.col("path"), rules)
    judged = named.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    hosts = scratch.keep(judged.filter("host != ''").groupBy("host").agg(F.count_if(F.col("by_rule") == "allow").alias("good"), F.count_if(F.col("by_rule") == "block").alias("bad")))
    good, bad = hosts.agg(F.coalesce(F.sum("good"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    edges = scratch.keep(host_edges(named))
    seeds = lambda c, n: hosts.filter(F.col(c) > 0).select("host", (F.col(c) / F.lit(float(max(n, 1)))).alias("mass"))
    trust = personal_rank(seeds("good", good), edges, scratch, damping, rounds).withColumnRenamed("rank", "trust")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = personal_rank(seeds("bad", bad), back, scratch, damping, rounds).withColumnRenamed("rank", "distrust")
    ranks = scratch.keep(trust.join(distrust, "host", "full"))
    out = judged.join(ranks, "host", "left")
    t, d = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    by_host = F.when(d > F.lit(ratio) * t, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_host).alias("verdict"), t.alias("trust"), d.alias("distrust"))
