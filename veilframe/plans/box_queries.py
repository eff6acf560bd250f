"""Queries over boxes and annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.operators import annotations, audit, boxes
from veilframe.operators.boxes import Box
from veilframe.plans import proxies as P

W, H = 1000, 1000
_BOX = ", b AS (SELECT *, xtl + w AS xbr, ytl + h AS ybr FROM p)"


def _boxes(spark, sf_dir) -> DataFrame:
    x = P.frame(spark, sf_dir, P.BOX)
    return x.withColumn("xbr", F.col("xtl") + F.col("w")).withColumn("ybr", F.col("ytl") + F.col("h"))


def _ints(b: Box) -> list:
    return b.each(lambda c: c.cast("long")).columns()


def box_rescale(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes.rescale(Box.of(), F.lit(1000), F.lit(1000), F.lit(1654), F.lit(2339))
    return _boxes(spark, sf_dir).select("page_no", "pos", *_ints(b))


def box_enlarge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boxes(spark, sf_dir).select("page_no", "pos", *_ints(boxes.enlarge(Box.of(), 1.5, F.lit(W), F.lit(H))))


def box_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes.snap(Box.of(), F.lit(W), F.lit(H), F.lit(1100), F.lit(1200), 40.0)
    return _boxes(spark, sf_dir).select("page_no", "pos", *b.columns())


def box_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes.stretch(Box.of(), F.lit(1.0) + F.col("pos") / 10.0, F.col("pos") - 5, 4 - F.col("pos"))
    return _boxes(spark, sf_dir).select("page_no", "pos", *_ints(b))


def box_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = boxes.center(Box.of())
    return _boxes(spark, sf_dir).select("page_no", "pos", x.cast("long").alias("cx"), y.cast("long").alias("cy"), Box.of().area().cast("long").alias("area"), F.round(boxes.distance(F.lit(0), F.lit(0), x, y), 6).alias("far"))


def _split(spark, sf_dir):
    b = _boxes(spark, sf_dir)
    return b.filter("label = 'censor-close'"), b.filter("label = 'censor'")


def box_smallest_container(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes.smallest_containing(*_split(spark, sf_dir), ["page_no"])


def box_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes.coverage(*_split(spark, sf_dir), ["page_no"])


def box_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner, outer = _split(spark, sf_dir)
    o = outer.filter("is_partial").select(F.col("page_no").alias("op"), F.col("pos").alias("outer_pos"), *Box.of().columns("o_"))
    x = inner.join(o, F.col("page_no") == F.col("op"))
    return x.select("page_no", "pos", "outer_pos", *_ints(boxes.clip(Box.of(), Box.of("o_"))))


def box_worst_corner(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = audit.worst_corners(_boxes(spark, sf_dir))
    return x.select("page_no", F.col("max_xtl").cast("long").alias("max_xtl"), F.col("max_ytl").cast("long").alias("max_ytl"))


def resolution_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    corners = audit.worst_corners(_boxes(spark, sf_dir))
    pages = corners.select("page_no", (F.col("page_no") % 7 * 2000 + 400).alias("width"), (F.col("page_no") % 5 * 2000 + 400).alias("height"))
    return audit.resolution_qa(pages, corners, W, H)


def resolution_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.qa_totals(resolution_qa(spark, sf_dir))



def _similar(b: Box):
    return boxes.project_similar(b, F.lit(10.0), F.lit(20.0), F.lit(1.1), F.lit(5.0), F.lit(-3.0), F.lit(2.0))


def quad_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _boxes(spark, sf_dir)
    q = F.array(*(boxes.point(F.col(x) + dx, F.col(y) + dy) for x, y, dx, dy in (("xtl", "ytl", 0, 0), ("xbr", "ytl", 0, 40), ("xbr", "ybr", -30, 40), ("xtl", "ybr", -30, 0))))
    p = F.col("pos").cast("long")
    out = b.select("page_no", "pos", boxes.stretch_quad(q, 0.9 + p / 20, (p % 3 - 1) * 7.0, (p % 5 - 2) * 3.0).alias("q"))
    return out.select("page_no", "pos", *(F.round(F.get("q", F.lit(i))[c], 6).alias(f"{c}{i}") for i in range(4) for c in "xy"))


def box_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _boxes(spark, sf_dir).select("page_no", "pos", _similar(Box.of()).alias("s"), boxes.project_homography(Box.of(), F.array(*[F.lit(v) for v in (1.02, 0.01, 3.0, -0.02, 0.98, 5.0, 0.00001, 0.00002, 1.0)])).alias("h"))
    return x.select("page_no", "pos", *[F.round(F.col(c)[k][a], 6).alias(f"{c}{k}{a}") for c in ("s", "h") for k in (0, 2) for a in ("x", "y")])


def transform_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = Box(F.lit(0.0), F.lit(0.0), F.lit(100.0), F.lit(100.0))
    corners = boxes.project_similar(probe, F.lit(0.0), F.lit(0.0), F.lit(0.5) + F.col("pos") / 8.0, F.lit(0.0), F.lit(0.0), F.col("page_no").cast("double"))
    x = _boxes(spark, sf_dir).select("page_no", "pos", boxes.validity(corners).alias("v"))
    return x.select("page_no", "pos", "v.ok")


def stripe_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _boxes(spark, sf_dir).select("page_no", "pos", F.posexplode(boxes.stripe_plan(F.col("h").cast("double"), float(W))).alias("k", "s"))
    return x.select("page_no", "pos", F.col("k").cast("long").alias("k"), F.round("s.start", 6).alias("start"), F.round("s.stop", 6).alias("stop"))


def _documents(spark, sf_dir) -> DataFrame:
    """Annotation documents made from boxes: attribute lists as one text, a JSON list, or nothing, by page."""
    b = _boxes(spark, sf_dir)
    region = F.struct("pos", F.struct(*[(F.col(c) / 10.0).alias(n) for c, n in (("xtl", "x"), ("ytl", "y"), ("w", "width"), ("h", "height"))], F.lit(W).alias("original_width"), F.lit(H).alias("original_height"), F.array("label").alias("rectanglelabels")).alias("r"))
    pages = b.groupBy("page_no").agg(F.transform(F.array_sort(F.collect_list(region)), lambda x: x["r"]).alias("label"))
    return pages.select(
        F.lit("q_1").alias("template"), F.col("page_no").alias("doc_pos"), F.concat(F.lit("/data/page_"), "page_no", F.lit(".png")).alias("image"), F.when(F.col("page_no") % 6 > 0, F.lit("P")).alias("image_type"),
        F.when(F.col("page_no") % 3 == 0, F.lit('["align","blank"]')).when(F.col("page_no") % 3 == 1, F.lit("standard")).alias("roi_type"), F.lit('["partial","full","partial"]').alias("censor_type"), F.lit(None).cast("string").alias("close_type"), "label",
    )


def annotation_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = annotations.boxes(_documents(spark, sf_dir))
    return x.select(F.col("page_no").cast("long").alias("page_no"), F.col("pos").cast("long").alias("pos"), "label", "sub_attribute", *[F.round(c, 6).alias(c) for c in ("xtl", "ytl", "xbr", "ybr")])


def annotation_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = annotations.boxes(_documents(spark, sf_dir))
    pick = lambda d, n: d.groupBy("page_no").agg(F.count("*").alias(n))
    c = annotations.censor_boxes(x).groupBy("page_no").agg(F.count("*").alias("n_censor"), F.count_if("is_partial").alias("n_partial"))
    out = c.join(pick(annotations.close_boxes(x), "n_close"), "page_no", "left").join(pick(annotations.align_boxes(x), "n_align"), "page_no", "left").join(annotations.page_type(_documents(spark, sf_dir)), "page_no").join(annotations.page_size(_documents(spark, sf_dir)).drop("template"), "page_no")
    return out.select(F.col("page_no").cast("long").alias("page_no"), "n_censor", "n_partial", F.coalesce("n_close", F.lit(0)).cast("long").alias("n_close"), F.coalesce("n_align", F.lit(0)).cast("long").alias("n_align"), "image_type", F.col("width").cast("long").alias("width"))


def _xml(spark, sf_dir) -> DataFrame:
    b = _boxes(spark, sf_dir)
    attr = lambda n, v: F.concat(F.lit(f'<attribute name="{n}">'), v, F.lit("</attribute>"))
    box = F.concat(F.lit('<box label="'), "label", F.lit('" xtl="'), "xtl", F.lit('" ytl="'), "ytl", F.lit('" xbr="'), "xbr", F.lit('" ybr="'), "ybr", F.lit('">'), attr("kind", F.lit("a")), F.when(F.col("pos") % 2 == 0, attr("blank", F.when(F.col("is_partial"), "true").otherwise("false"))).otherwise(F.lit("")), F.lit("</box>"))
    return b.groupBy("page_no").agg(F.concat(F.lit('<image id="'), "page_no", F.lit('" name="p'), "page_no", F.lit('" width="1000" height="1000">'), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", box.alias("t")))), lambda x: x["t"]), ""), F.lit("</image>")).alias("xml"))


def xml_label_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veilframe.sources.files import parse_xml

    x = annotations.label_summary(annotations.xml_boxes(parse_xml(_xml(spark, sf_dir), "xml")))
    n = lambda k: F.coalesce(F.col("counts")[k], F.lit(0)).cast("long")
    return x.select("name", n("censor").alias("n_censor"), n("censor-close").alias("n_close"), n("roi").alias("n_roi"), F.concat_ws(",", "blanks").alias("blanks"))


def xml_set_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    from veilframe.sources.files import parse_xml

    x = annotations.set_attribute(annotations.xml_boxes(parse_xml(_xml(spark, sf_dir), "xml")), "blank", "set", ["roi"], overwrite=False)
    return x.groupBy("label").agg(F.count_if("changed").alias("changed"), F.count_if(F.col("attributes")["blank"] == "set").alias("n_set"), F.count("*").alias("n"))


QUERIES = [
    (box_rescale, P.with_views(_BOX + " SELECT page_no, pos, CAST(trunc(xtl * (1654 / 1000.0::DOUBLE)) AS BIGINT) AS xtl, CAST(trunc(ytl * (2339 / 1000.0::DOUBLE)) AS BIGINT) AS ytl, CAST(trunc(xbr * (1654 / 1000.0::DOUBLE)) AS BIGINT) AS xbr, CAST(trunc(ybr * (2339 / 1000.0::DOUBLE)) AS BIGINT) AS ybr FROM b", p=P.BOX)),
    (
        box_enlarge,
        P.with_views(
            _BOX
            + """, e AS (SELECT page_no, pos, xtl + w / 2.0 - w * 1.5 / 2 AS x0, xtl + w / 2.0 + w * 1.5 / 2 AS x1, ytl + h / 2.0 - h * 1.5 / 2 AS y0, ytl + h / 2.0 + h * 1.5 / 2 AS y1 FROM b)
SELECT page_no, pos, CAST(trunc(greatest(x0 - greatest(x1 - 1000, 0), 0)) AS BIGINT) AS xtl, CAST(trunc(greatest(y0 - greatest(y1 - 1000, 0), 0)) AS BIGINT) AS ytl,
  CAST(trunc(least(x1 + greatest(-x0, 0), 1000)) AS BIGINT) AS xbr, CAST(trunc(least(y1 + greatest(-y0, 0), 1000)) AS BIGINT) AS ybr FROM e""",
            p=P.BOX,
        ),
    ),
    (box_snap, P.with_views(_BOX + " SELECT page_no, pos, " + ", ".join(f"CAST(CASE WHEN (CASE WHEN {c} <= 40 THEN 0 ELSE {c} END) >= 960 THEN {n} WHEN {c} <= 40 THEN 0 ELSE {c} END AS DOUBLE) AS {c}" for c, n in (("xtl", 1100), ("ytl", 1200), ("xbr", 1100), ("ybr", 1200))) + " FROM b", p=P.BOX)),
    (
        box_stretch,
        P.with_views(
            _BOX
            + """, e AS (SELECT *, 1.0::DOUBLE + pos / 10.0::DOUBLE AS s, pos - 5 AS sx, 4 - pos AS sy FROM b)
SELECT page_no, pos, CAST(trunc(xtl + w / 2.0::DOUBLE - w * s / 2 + least(sx, 0)) AS BIGINT) AS xtl, CAST(trunc(ytl + h / 2.0::DOUBLE - h * s / 2 + least(sy, 0)) AS BIGINT) AS ytl,
  CAST(trunc(xtl + w / 2.0::DOUBLE + w * s / 2 + greatest(sx, 0)) AS BIGINT) AS xbr, CAST(trunc(ytl + h / 2.0::DOUBLE + h * s / 2 + greatest(sy, 0)) AS BIGINT) AS ybr FROM e""",
            p=P.BOX,
        ),
    ),
    (box_centers, P.with_views(_BOX + ", c AS (SELECT page_no, pos, CAST(floor((xtl + xbr) / 2.0) AS BIGINT) AS cx, CAST(floor((ytl + ybr) / 2.0) AS BIGINT) AS cy, CAST(w * h AS BIGINT) AS area FROM b) SELECT *, round(sqrt(CAST(cx * cx + cy * cy AS DOUBLE)), 6) AS far FROM c", p=P.BOX)),
    (
        box_smallest_container,
        P.with_views(
            _BOX
            + """, i AS (SELECT * FROM b WHERE label = 'censor-close'), o AS (SELECT * FROM b WHERE label = 'censor'),
  j AS (SELECT i.page_no, i.pos, o.pos AS op, row_number() OVER (PARTITION BY i.page_no, i.pos ORDER BY o.w * o.h, o.pos) AS r FROM i LEFT JOIN o ON o.page_no = i.page_no AND o.xtl <= i.xtl AND o.ytl <= i.ytl AND o.xbr >= i.xbr AND o.ybr >= i.ybr)
SELECT page_no, pos, op AS outer_pos FROM j WHERE r = 1""",
            p=P.BOX,
        ),
    ),
    (
        box_coverage,
        P.with_views(
            _BOX
            + """, j AS (SELECT i.page_no, i.pos AS inner_pos, o.pos AS outer_pos, CAST(greatest(least(i.xbr, o.xbr) - greatest(i.xtl, o.xtl), 0) * greatest(least(i.ybr, o.ybr) - greatest(i.ytl, o.ytl), 0) AS DOUBLE) / (i.w * i.h) AS c, o.is_partial
  FROM b i JOIN b o ON i.page_no = o.page_no AND i.label = 'censor-close' AND o.label = 'censor')
SELECT page_no, inner_pos, outer_pos, round(c, 6) AS coverage, is_partial FROM j WHERE c >= 0.5""",
            p=P.BOX,
        ),
    ),
    (
        box_clip,
        P.with_views(
            _BOX
            + """ SELECT i.page_no, i.pos, o.pos AS outer_pos, CAST(greatest(i.xtl, o.xtl) AS BIGINT) AS xtl, CAST(greatest(i.ytl, o.ytl) AS BIGINT) AS ytl, CAST(least(i.xbr, o.xbr) AS BIGINT) AS xbr, CAST(least(i.ybr, o.ybr) AS BIGINT) AS ybr
FROM b i JOIN b o ON i.page_no = o.page_no AND i.label = 'censor-close' AND o.label = 'censor' AND o.is_partial""",
            p=P.BOX,
        ),
    ),
    (box_worst_corner, P.with_views(" SELECT page_no, CAST(coalesce(max(xtl) FILTER (label = 'censor'), 0) AS BIGINT) AS max_xtl, CAST(coalesce(max(ytl) FILTER (label = 'censor'), 0) AS BIGINT) AS max_ytl FROM p GROUP BY 1", p=P.BOX)),
    (
        resolution_qa,
        _QA := P.with_views(
            """, c AS (SELECT page_no, coalesce(max(xtl) FILTER (label = 'censor'), 0) AS mx, coalesce(max(ytl) FILTER (label = 'censor'), 0) AS my, page_no % 7 * 2000 + 400 AS w, page_no % 5 * 2000 + 400 AS h FROM p GROUP BY 1),
  r AS (SELECT *, 1000.0::DOUBLE / w AS rx, 1000.0::DOUBLE / h AS ry FROM c)
SELECT page_no, round(greatest(rx, ry), 6) AS ratio, mx > 1000 * rx OR my > 1000 * ry AS redo, rx > 1.5 OR ry > 1.5 AS over FROM r""",
            p=P.BOX,
        ),
    ),
    (
        quad_stretch,
        P.with_views(
            _BOX
            + """, q AS (SELECT page_no, pos, greatest(0.9::DOUBLE + pos / 20.0::DOUBLE, 1) AS s, (pos % 3 - 1) * 7.0::DOUBLE AS sx, (pos % 5 - 2) * 3.0::DOUBLE AS sy,
    [xtl, xbr, xbr - 30, xtl - 30]::DOUBLE[] AS px, [ytl, ytl + 40, ybr + 40, ybr]::DOUBLE[] AS py FROM b),
  g AS (SELECT *, list_avg(px) AS mx, list_avg(py) AS my FROM q),
  t AS (SELECT *, list_transform(px, lambda v: mx + (v - mx) * s) AS tx, list_transform(py, lambda v: my + (v - my) * s) AS ty FROM g),
  u AS (SELECT *, sqrt((tx[2] - tx[1]) ** 2 + (ty[2] - ty[1]) ** 2) AS n1, sqrt((tx[4] - tx[1]) ** 2 + (ty[4] - ty[1]) ** 2) AS n3 FROM t),
  w AS (SELECT *, (tx[2] - tx[1]) / n1 AS ax, (ty[2] - ty[1]) / n1 AS ay, (tx[4] - tx[1]) / n3 AS dx, (ty[4] - ty[1]) / n3 AS dy, greatest(sx, 0) AS r, least(sx, 0) AS l, greatest(sy, 0) AS d, least(sy, 0) AS o FROM u)
SELECT page_no, pos, round(tx[1] + ax * l + dx * o, 6) AS x0, round(ty[1] + ay * l + dy * o, 6) AS y0, round(tx[2] + ax * r + dx * o, 6) AS x1, round(ty[2] + ay * r + dy * o, 6) AS y1,
  round(tx[3] + ax * r + dx * d, 6) AS x2, round(ty[3] + ay * r + dy * d, 6) AS y2, round(tx[4] + ax * l + dx * d, 6) AS x3, round(ty[4] + ay * l + dy * d, 6) AS y3 FROM w""",
            p=P.BOX,
        ),
    ),
    (resolution_totals, f"SELECT count_if(redo) AS pages_to_redo, count_if(over) AS ratios_over, count(*) AS n_pages FROM ({_QA})"),
    (
        box_project,
        P.with_views(
            _BOX
            + """, c AS (SELECT page_no, pos, (xtl + xbr) / 2.0::DOUBLE + 5 - w * 1.1::DOUBLE / 2 AS x0, (xtl + xbr) / 2.0::DOUBLE + 5 + w * 1.1::DOUBLE / 2 AS x2, (ytl + ybr) / 2.0::DOUBLE - 3 - h * 1.1::DOUBLE / 2 AS y0, (ytl + ybr) / 2.0::DOUBLE - 3 + h * 1.1::DOUBLE / 2 AS y2, cos(radians(-2.0)) AS c, sin(radians(-2.0)) AS s,
  CAST(xtl AS DOUBLE) AS a, CAST(ytl AS DOUBLE) AS b, CAST(xbr AS DOUBLE) AS d, CAST(ybr AS DOUBLE) AS e FROM b)
SELECT page_no, pos, round(c * (x0 - 10) - s * (y0 - 20) + 10, 6) AS s0x, round(s * (x0 - 10) + c * (y0 - 20) + 20, 6) AS s0y, round(c * (x2 - 10) - s * (y2 - 20) + 10, 6) AS s2x, round(s * (x2 - 10) + c * (y2 - 20) + 20, 6) AS s2y,
  round((1.02 * a + 0.01 * b + 3) / (0.00001 * a + 0.00002 * b + 1), 6) AS h0x, round((-0.02 * a + 0.98 * b + 5) / (0.00001 * a + 0.00002 * b + 1), 6) AS h0y,
  round((1.02 * d + 0.01 * e + 3) / (0.00001 * d + 0.00002 * e + 1), 6) AS h2x, round((-0.02 * d + 0.98 * e + 5) / (0.00001 * d + 0.00002 * e + 1), 6) AS h2y FROM c""",
            p=P.BOX,
        ),
    ),
    (transform_valid, P.with_views(" SELECT page_no, pos, (0.5 + pos / 8.0) * (0.5 + pos / 8.0) BETWEEN 0.4 AND 1.6 AS ok FROM p", p=P.BOX)),
    (
        stripe_intervals,
        P.with_views(
            """, s AS (SELECT page_no, pos, CAST(h AS DOUBLE) AS h, 1000 * 0.04::DOUBLE / (1 - 2.0::DOUBLE / 3) AS block FROM p), k AS (SELECT *, unnest(range(0, CAST(ceil(h / block) AS BIGINT))) AS k FROM s)
SELECT page_no, pos, k, round(k * block, 6) AS start, round(least(k * block + block * (2.0::DOUBLE / 3), h), 6) AS stop FROM k""",
            p=P.BOX,
        ),
    ),
    (
        annotation_boxes,
        P.with_views(
            _BOX
            + """, k AS (SELECT *, row_number() OVER (PARTITION BY page_no, label ORDER BY pos) AS k FROM b)
SELECT page_no, pos, label, CASE WHEN label = 'censor' THEN CASE WHEN k = 2 THEN 'full' WHEN k <= 3 THEN 'partial' END WHEN label = 'roi' AND page_no % 3 = 0 THEN CASE k WHEN 1 THEN 'align' WHEN 2 THEN 'blank' END WHEN label = 'roi' AND page_no % 3 = 1 AND k = 1 THEN 'standard' END AS sub_attribute,
  round(CAST(xtl AS DOUBLE), 6) AS xtl, round(CAST(ytl AS DOUBLE), 6) AS ytl, round(CAST(xbr AS DOUBLE), 6) AS xbr, round(CAST(ybr AS DOUBLE), 6) AS ybr FROM k""",
            p=P.BOX,
        ),
    ),
    (
        annotation_picks,
        P.with_views(
            """, g AS (SELECT page_no, count_if(label = 'censor') AS n_censor, count_if(label = 'censor-close') AS n_close, count_if(label = 'roi') AS n_roi FROM p GROUP BY 1)
SELECT page_no, n_censor, CASE WHEN n_censor >= 3 THEN 2 WHEN n_censor >= 1 THEN 1 ELSE 0 END::BIGINT AS n_partial, n_close, CASE WHEN page_no % 3 = 0 AND n_roi > 0 THEN 1 ELSE 0 END::BIGINT AS n_align, CASE WHEN page_no % 6 > 0 THEN 'P' ELSE '' END AS image_type, 1000::BIGINT AS width FROM g WHERE n_censor > 0""",
            p=P.BOX,
        ),
    ),
    (xml_label_summary, P.with_views(" SELECT 'p' || page_no AS name, count_if(label = 'censor') AS n_censor, count_if(label = 'censor-close') AS n_close, count_if(label = 'roi') AS n_roi, coalesce(string_agg(CASE WHEN is_partial THEN 'true' ELSE 'false' END, ',' ORDER BY pos) FILTER (label = 'roi' AND pos % 2 = 0), '') AS blanks FROM p GROUP BY page_no", p=P.BOX)),
    (xml_set_attribute, P.with_views(" SELECT label, count_if(label = 'roi' AND pos % 2 = 1) AS changed, count_if(label = 'roi' AND pos % 2 = 1) AS n_set, count(*) AS n FROM p GROUP BY 1", p=P.BOX)),
]
