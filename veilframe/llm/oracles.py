"""SQL for the queries of this folder that SQL can express; for DuckDB, over the driver's views."""

from __future__ import annotations

from veilframe.llm.dart_minhash import SHINGLE, THRESHOLD
from veilframe.llm.url_trust import LINK, LOWER, RULES, UPPER

#: Rounds of the ranks in SQL, which can't stop by itself: 0.85 ** 150 of the mass is below what the query shows.
ROUNDS = 150

_HOST = r"translate(coalesce(regexp_extract({}, '(?s)^.*?://([^/?#]*)', 1), ''), '" + UPPER + "', '" + LOWER + "')"


def _cases(value) -> str:
    """The value of the longest rule that fits, else null."""
    longest = sorted(RULES, key=lambda r: (-len(r.name), r.verdict != "block"))
    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    return "CASE " + " ".join(f"WHEN {fits(r)} THEN '{value(r)}'" for r in longest) + " END"


def _rank(name: str, seeds: str, src: str, dst: str) -> str:
    """Tables <name>_0, <name>_s, <name>_r and <name>: host, rank over the edges from src to dst."""
    return f"""
{name}_0 AS (SELECT host, {seeds} / (SELECT greatest(sum({seeds}), 1) FROM hosts)::DOUBLE AS mass FROM hosts WHERE {seeds} > 0),
{name}_s AS (SELECT {src} AS src, {dst} AS dst, n / sum(n) OVER (PARTITION BY {src})::DOUBLE AS share FROM edges),
{name}_r(k, host, rank) AS (
  SELECT 0, host, mass FROM {name}_0
  UNION ALL
  SELECT k, host, sum(rank) FROM (
    SELECT k + 1 AS k, dst AS host, rank * share * 0.85::DOUBLE AS rank FROM {name}_r JOIN {name}_s ON src = host
    UNION ALL
    SELECT k, z.host, z.mass * 0.15::DOUBLE FROM {name}_0 z CROSS JOIN (SELECT max(k) + 1 AS k FROM {name}_r) one
  ) WHERE k <= {ROUNDS} GROUP BY k, host),
{name} AS (SELECT host, rank / sum(rank) OVER () AS rank FROM {name}_r WHERE k = {ROUNDS})"""


URL_TRUST = (
    "WITH RECURSIVE p AS (SELECT page_id, "
    + _HOST.format("url")
    + r" AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, html FROM pages),"
    + f"\nj AS (SELECT page_id, host, path, html, {_cases(lambda r: r.name)} AS rule, {_cases(lambda r: r.verdict)} AS by_rule FROM p),"
    + "\nhosts AS (SELECT host, count(*) FILTER (by_rule = 'allow') AS good, count(*) FILTER (by_rule = 'block') AS bad FROM j WHERE host <> '' GROUP BY host),"
    + "\nlinks AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '"
    + LINK.replace("'", "''")
    + "', 1)) AS link FROM p),\nends AS (SELECT src, "
    + _HOST.format("CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END")
    + " AS dst FROM links),\nedges AS (SELECT src, dst, count(*) AS n FROM ends WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY 1, 2),"
    + _rank("trusted", "good", "src", "dst")
    + ","
    + _rank("distrusted", "bad", "dst", "src")
    + """
SELECT page_id, j.host AS host, path, rule,
  coalesce(by_rule, CASE WHEN round(coalesce(d.rank, 0), 9) > round(coalesce(t.rank, 0), 9) THEN 'block' ELSE 'allow' END) AS verdict,
  round(coalesce(t.rank, 0), 9) AS trust, round(coalesce(d.rank, 0), 9) AS distrust
FROM j LEFT JOIN trusted t ON t.host = j.host LEFT JOIN distrusted d ON d.host = j.host"""
)

#: Links of all pairs of texts, by their elements, and the least id that links lead to.
NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT t, min(doc_id) AS id, list_filter(regexp_split_to_array(lower(t), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM d GROUP BY t),
e AS (SELECT id, CASE WHEN len(w) < {SHINGLE} THEN [w] ELSE list_transform(range(1, len(w) - {SHINGLE} + 2), lambda i: w[i:i + {SHINGLE - 1}]) END AS e FROM w WHERE len(w) > 0),
x AS (SELECT id, unnest(e) AS s FROM e),
c AS (SELECT id, s, count(*) AS n FROM x GROUP BY 1, 2),
size AS (SELECT id, sum(n) AS size FROM c GROUP BY 1),
p AS (SELECT a.id AS a, b.id AS b, sum(least(a.n, b.n)) AS common FROM c a JOIN c b ON a.s = b.s AND a.id < b.id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN size m ON m.id = a JOIN size n ON n.id = b WHERE common >= {THRESHOLD}::DOUBLE * (m.size + n.size - common)),
links AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, root) AS (SELECT id, id FROM size UNION SELECT links.b, r.root FROM r JOIN links ON links.a = r.id WHERE r.root < links.b),
class AS (SELECT id, min(root) AS class_id FROM r GROUP BY 1)
SELECT d.doc_id AS doc_id, coalesce(class.class_id, d.doc_id) AS class_id FROM d JOIN w USING (t) LEFT JOIN class ON class.id = w.id"""
