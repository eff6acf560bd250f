"""Operators on small tables with hand-made answers."""

import io
import json
import tarfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from veilframe.functions import kernels
from veilframe.operators import annotations, assign, audit, boxes, decide, execute, ledger, manifest, redact, text
from veilframe.operators.boxes import Box
from veilframe.sources import adapters, files
from veilframe.streaming import ledger as stream


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def box(*v):
    return Box(*[F.lit(float(x)) for x in v])


def test_geometry(spark):
    e = one(spark, *boxes.enlarge(box(0, 0, 10, 10), 2, F.lit(100), F.lit(100)).columns("e_"), *boxes.rescale(box(1, 1, 3, 3), F.lit(2), F.lit(2), F.lit(3), F.lit(3)).columns("r_"), *boxes.clip(box(-5, 2, 8, 20), box(0, 0, 10, 10)).columns("c_"), *boxes.from_percent(F.lit(10), F.lit(5), F.lit(20), F.lit(10), F.lit(1000), F.lit(2000)).columns("p_"))
    assert tuple(e) == (0, 0, 20, 20, 1, 1, 4, 4, 0, 2, 8, 10, 100, 100, 300, 300)
    x = one(spark, *[c.alias(n) for c, n in zip(boxes.center(box(0, 0, 5, 5)), "xy", strict=True)], boxes.mean_point(boxes.polygon(box(0, 0, 5, 4))).alias("m"), boxes.order_quad(F.array(*[boxes.point(F.lit(a), F.lit(b)) for a, b in ((9, 9), (0, 8), (1, 1), (8, 0))])).alias("q"), *boxes.bounds(boxes.polygon(box(1.7, -1.2, 3.9, 4))).columns())
    assert (x.x, x.y, x.m.x, x.m.y) == (2, 2, 2, 2)
    assert [(p.x, p.y) for p in x.q] == [(1, 1), (8, 0), (9, 9), (0, 8)]
    assert (x.xtl, x.ytl, x.xbr, x.ybr) == (1, -1, 3, 4)


def test_validity(spark):
    probe = box(0, 0, 100, 100)
    similar = lambda s, d: boxes.project_similar(probe, F.lit(0.0), F.lit(0.0), F.lit(float(s)), F.lit(0.0), F.lit(0.0), F.lit(float(d)))
    bow = F.array(*[boxes.point(F.lit(a), F.lit(b)) for a, b in ((0, 0), (100, 100), (100, 0), (0, 100))])
    skew = F.array(*[boxes.point(F.lit(a), F.lit(b)) for a, b in ((0, 0), (100, 0), (150, 100), (50, 100))])
    r = one(spark, *[boxes.validity(c).alias(n) for n, c in (("a", similar(1, 20)), ("b", similar(0.5, 0)), ("c", bow), ("d", skew))])
    assert r.a.ok and r.b.reason == "Area error: 0.25x size" and r.c.reason.startswith("Non-convex") and r.d.reason.startswith("Bad angle at corner 0: 63.4")


def test_rescale_and_inverse(spark):
    b = box(100, 50, 300, 250)
    there = boxes.project_similar(b, F.lit(0.0), F.lit(0.0), F.lit(1.2), F.lit(7.0), F.lit(-4.0), F.lit(0.0))
    r = one(spark, boxes.project_similar(Box(there[0]["x"], there[0]["y"], there[2]["x"], there[2]["y"]), F.lit(0.0), F.lit(0.0), F.lit(1.2), F.lit(7.0), F.lit(-4.0), F.lit(0.0), inverse=True).alias("p"))
    assert (r.p[0].x, r.p[0].y, r.p[2].x, r.p[2].y) == pytest.approx((100, 50, 300, 250))


def test_fit_similarity(spark):
    pts = lambda v: F.array(*[F.struct(*[F.lit(float(x)).alias(n) for x, n in zip(p, ("cx", "cy", "sx", "sy"), strict=True)]) for p in v])
    v = [(10, 10, 5, 3), (110, 210, 15, 23), (50, 60, 9, 8)]
    r = one(spark, *[boxes.fit_similarity(pts(v), s).alias(s) for s in ("top_left", "most_distant", "origin")], boxes.fit_similarity(pts(v[:1])).alias("few"))
    want = np.hypot(110, 220) / np.hypot(100, 200)
    for k in ("top_left", "most_distant", "origin"):
        assert (r[k].scale, r[k].shift_x, r[k].shift_y, r[k].ref_x) == pytest.approx((want, 5, 3, 10))
    assert tuple(r.few) == (1, 0, 0, 0, 0, 0)


def test_stretch_all(spark):
    r = one(spark, *boxes.stretch_all(box(0, 0, 10, 10), F.lit(1.0), F.array(F.lit(4), F.lit(-3)), F.array(F.lit(2), F.lit(1))).columns())
    assert tuple(r) == (-3, 0, 14, 13)


def test_variant_by_aspect(spark):
    df = spark.createDataFrame([("a", 100, 140), ("a", 100, 105), ("b", 100, 140)], "subject_id string, width int, height int")
    assert {r.subject_id: r.variant for r in boxes.variant_by_aspect(df).collect()} == {"a": 2, "b": 1}


def test_text(spark):
    df = spark.createDataFrame([("x 123456 7 y",), ("ab12c345",), ("none",), ("12 34",)], "t string")
    assert [r[0] for r in df.select(text.numeric_target(F.col("t"))).collect()] == ["1234567", "345", None, "12"]
    r = one(spark, *[text.compare(F.lit(a), F.lit(b)).alias(n) for n, a, b in (("p", "a b", "B c"), ("q", "", ""), ("r", "a", ""))], text.normalise(F.lit("ﬁ  Ａ–b!"), nfkc=True).alias("n"))
    assert r.p.jaccard == pytest.approx(1 / 3) and r.p.containment == 0.5 and (r.q.jaccard, r.r.jaccard) == (1.0, 0.0) and r.n == "fi a b"
    assert one(spark, text.page_of_path(F.lit("/a/page_12.png")), text.page_of_path(F.lit("/a/b.png"))) == (12, None)


def test_manifest_order_of_steps(spark):
    df = spark.createDataFrame([("s1", "a.b.tif"), ("s1", "a.b.pdf"), ("s2", "c.tif"), ("s3", "c.pdf"), (None, "d"), ("s4", None), ("s4", "e")], "subject_id string, object_name string")
    got = [(r.subject_id, r.object_name, r.used) for r in manifest.prepare(df).collect()]
    assert got == [("s1", "a.b", False), ("s4", "e", False)]
    few = spark.createDataFrame([(1,), (2,)], "k long")
    assert {r.shard for r in manifest.contiguous_shard(few, 5, "k").collect()} == {4}
    with pytest.raises(Exception, match="no page number"):
        df.select(manifest.page_number(F.col("object_name"), strict=True)).collect()
    nth = manifest.nth_file(spark.createDataFrame([("p_2.png",), ("p_10.png",)], "path string"), spark.createDataFrame([(1,), (2,), (3,)], "page_no long"))
    assert {r.page_no: r.path for r in nth.collect()} == {1: "p_2.png", 2: "p_10.png", 3: None}


def test_ledger_edges(spark):
    df = spark.createDataFrame([("a", 1, "success", 2.0), ("a", 2, None, None), ("b", 3, "failed", 5.0)], "subject_id string, ingest_pos long, status string, secs double")
    assert {r.subject_id: r.ingest_pos for r in ledger.latest(df).collect()} == {"a": 2, "b": 3}
    assert ledger.without_status(df).count() == 2 and ledger.slowest(df, 1).first().subject_id == "b"
    assert ledger.stack([df, df.drop("secs")]).count() == 6
    assert ledger.frequencies(df, "status", True).count() == 3
    b = df.withColumn("batch_id", F.lit("x"))
    assert ledger.batches_to_successes(b.union(b)).count() == 1


def test_annotations_from_json(spark, tmp_path):
    import json

    region = lambda label, x: {"x": x, "y": 0, "width": 10, "height": 10, "original_width": 200, "original_height": 100, "rectanglelabels": [label]}
    doc = [{"image": "d/page_1.png", "image_type": "P", "roi_type": ["standard", "blank", "text", "blank"], "censor_type": "partial", "label": [region("roi", k) for k in range(4)] + [region("censor", 5), region("censor", 6)]}, {"image": "d/page_1.png", "label": []}, {"image": "d/page_2.png", "image_type": "N", "label": []}]
    (tmp_path / "q_1.json").write_text(json.dumps(doc))
    raw = files.read_annotations(spark, str(tmp_path))
    b = annotations.boxes(raw)
    assert [(r.label, r.sub_attribute, r.xtl) for r in b.orderBy("pos").collect()] == [("roi", "standard", 0), ("roi", "blank", 2), ("roi", "text", 4), ("roi", "blank", 6), ("censor", "partial", 10), ("censor", None, 12)]
    assert [(r.sub_attribute, r.xtl) for r in annotations.roi_boxes(b).orderBy("place").collect()] == [("standard", 0), ("text", 4), ("blank", 6)]
    assert annotations.page_numbers(raw).first().page_nos == [1, 1, 2]
    assert {r.page_no: (r.width, r.height) for r in annotations.page_size(raw).collect()} == {1: (200, 100), 2: (None, None)}
    assert [r.is_partial for r in annotations.censor_boxes(b).orderBy("pos").collect()] == [True, False]
    with pytest.raises(Exception, match="no blank region"):
        annotations.roi_boxes(b.filter("label = 'censor'")).collect()


def test_xml_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<annotations><image id="0" name="p1" width="10" height="20"><box label="roi" xtl="1" ytl="2" xbr="3" ybr="5"><attribute name="blank">true</attribute></box></image><image id="1" name="p2"><box label="roi" xtl="1" ytl="2" xbr="0" ybr="5"/></image></annotations>')
    x = annotations.xml_boxes(annotations.find_images(files.read_xml(spark, str(tmp_path / "a.xml")), name="p1"))
    r = x.first()
    assert (r.attributes, r.area, r.cx) == ({"blank": "true"}, 6.0, 2.0)
    assert annotations.xml_boxes(files.read_xml(spark, str(tmp_path / "a.xml"))).filter("name = 'p2'").first().area == 0
    files.write_xml(files.read_xml(spark, str(tmp_path / "a.xml")), str(tmp_path / "out"))
    assert files.read_xml(spark, str(tmp_path / "out")).count() == 2


def test_stages(spark):
    pages = spark.createDataFrame([("s", k) for k in (1, 2, 3)], "subject_id string, page_no long")
    templates = spark.createDataFrame([("s", k) for k in (1, 2)], "subject_id string, template_no long")
    z = decide.zip_pairs(pages, templates)
    assert [(r.page_no, r.template_no) for r in z.orderBy("place").collect()] == [(1, 1), (2, 2)]
    f = decide.first_stage(z.withColumn("matched", F.col("page_no") == 1)).first()
    assert (f.passed, f.open_pages, f.open_templates) == (False, [2], [2])
    left = decide.open_pairs(pages, templates, z.filter("page_no = 1"), z)
    assert [(r.page_no, r.template_no) for r in left.collect()] == [(3, 2)]
    second = decide.second_stage(left, left.withColumn("matched", F.lit(True))).first()
    assert second.matched
    checks = spark.createDataFrame([("s", 1, 1, True), ("s", 2, 1, True), ("s", 3, 2, True)], "subject_id string, page_no long, template_no long, matched boolean")
    assert [r.template_no for r in decide.solved_once(checks, checks).collect()] == [2]
    assert decide.votes(checks.withColumnRenamed("matched", "ok"), 2, ["template_no"]).filter("ok").count() == 1


def test_assignment_report_flags(spark):
    costs = spark.createDataFrame([("s", 0, 0, 0.1), ("s", 0, 1, 0.9)], "subject_id string, page_no long, template_no long, cost double")
    chosen = assign.assign(costs)
    exact = assign.report(costs, chosen, 0.5, 0.3).first()
    assert exact.ok and exact.gap == pytest.approx(0.8)
    whole = assign.report(costs, chosen, 0.5, 0.3, integer_costs=True).first()
    assert not whole.ok and whole.gap == 0
    single = assign.report(costs.limit(1), assign.assign(costs.limit(1)), 5, 18).first()
    assert single.second == 1e9 and single.ok


def test_executor_statuses(spark):
    modes = ["ok", "py_exception", "hang", "worker_crash", "bad_result", "ok"]
    df = spark.createDataFrame([(f"t{k}", m, k) for k, m in enumerate(modes)], "subject_id string, mode string, value long")

    def work(group: pd.DataFrame, deadline) -> pd.DataFrame:
        import time

        mode = group["mode"].iloc[0]
        if mode == "py_exception":
            raise ValueError("bad input")
        if mode == "hang":
            time.sleep(1.2)
            deadline.check()
        if mode == "worker_crash":
            raise execute.WorkerError("gone")
        return group.drop(columns="value") if mode == "bad_result" else group

    got = {r.subject_id: r for r in execute.run_items(df, work, seconds=1.0).collect()}
    assert [got[f"t{k}"].status for k in range(6)] == ["success", "failed", "timeout", "worker_exception", "failed", "success"]
    assert got["t1"].error_type == "ValueError" and got["t1"].secs is None and "bad input" in got["t1"].error_traceback
    again = execute.retry(df, work, seconds=1.0, times=1).collect()
    assert len(again) == 6 and {r.subject_id: r.attempt for r in again}["t2"] == 1


def test_archives_and_adapters(spark, tmp_path):
    png = kernels.write_png(np.zeros((30, 40), np.uint8))
    df = spark.createDataFrame([("s", "b_2.png", bytearray(png)), ("s", "a_1.png", bytearray(png)), ("s", "x.txt", bytearray(b"no"))], "subject_id string, name string, data binary")
    tar = files.tar_folders(df)
    with tarfile.open(fileobj=io.BytesIO(tar.first().archive)) as t:
        assert t.getnames() == ["s/a_1.png", "s/b_2.png", "s/x.txt"]
    sizes = files.tar_image_sizes(tar.select(F.lit("p").alias("path"), F.col("archive").alias("content"))).orderBy("page_no").collect()
    assert [(r.page_no, r.width, r.height) for r in sizes] == [(1, 40, 30), (2, 40, 30)]
    raw = spark.createDataFrame([("a", bytearray(png)), ("b", bytearray(b"x"))], "path string, content binary")
    assert {r.path: (r.status, r.height) for r in adapters.page_images(raw, "png").collect()} == {"a": ("small", 100), "b": ("failed", 100)}
    assert {r.path: r.n_pages for r in adapters.page_counts(raw, "png").collect()} == {"a": 1, "b": 0}
    with pytest.raises(adapters.DecoderUnavailable):
        adapters.page_counts(raw, "pdf")


def test_listing_and_csv(spark, tmp_path):
    for n in ("a.pdf", "b.tif.pdf", "c.txt", "sub/d.pdf"):
        p = tmp_path / "f" / n
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x")
    names = lambda d: [r.path.rsplit("/", 1)[1] for r in d.collect()]
    root = str(tmp_path / "f")
    assert names(files.list_files(spark, root, "pdf")) == ["a.pdf", "b.tif.pdf"]
    assert names(files.list_files(spark, root, [".pdf", "txt"], recursive=True)) == ["a.pdf", "b.tif.pdf", "c.txt", "d.pdf"]
    assert files.list_folders(files.list_files(spark, root, "*", recursive=True)).count() == 2
    (tmp_path / "m.csv").write_bytes("object_name,subject_id\né.tif,1\n".encode("cp1252"))
    assert files.read_manifest(spark, str(tmp_path / "m.csv"), "windows-1252").first().object_name == "é.tif"


def test_code_page_beyond_latin(spark, tmp_path):
    names = ["€–“x”.tif", "Š…œž.tif"]
    (tmp_path / "m.csv").write_bytes(("object_name,subject_id\n" + "".join(f"{n},1\n" for n in names)).encode("cp1252"))
    assert [r.object_name for r in files.read_manifest(spark, str(tmp_path / "m.csv"), "cp1252").collect()] == names


def test_resolution_takes_each_axis_with_its_own_ratio(spark):
    pages = spark.createDataFrame([(1, 2000, 1000), (2, 1000, 1000), (3, 1000, 4000)], "page_no int, width int, height int")
    corners = spark.createDataFrame([(1, 1200, 0), (2, 1000, 1000), (3, 0, 300)], "page_no int, max_xtl int, max_ytl int")
    got = {r.page_no: (r.redo, r.over) for r in audit.resolution_qa(pages, corners, 1000, 1000).collect()}
    assert got == {1: (True, False), 2: (False, False), 3: (True, False)}


def test_unknown_questionnaires_and_unreadable_files(spark):
    rows = [("a", "x", 1, 1), ("b", "y", 0, 1), ("b", "z", None, 1)]
    df = spark.createDataFrame(rows, "subject_id string, object_name string, n_pages int, questionnaire int")
    assert [r.subject_id for r in decide.extraction_plan(df).collect()] == ["a"]
    assert [r.subject_id for r in decide.unreadable(df).collect()] == ["b"]
    for q in (99, None):
        bad = spark.createDataFrame([("a", "x", 1, q)], "subject_id string, object_name string, n_pages int, questionnaire int")
        with pytest.raises(Exception, match="no profile of questionnaire"):
            decide.extraction_plan(bad).collect()


def test_stream_of_ledgers(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("in", "out", "chk"))
    df = spark.createDataFrame([("a", "success"), ("b", "failed")], "subject_id string, status string")
    for batch, n in (("1", 2), (None, 2), ("2", 4)):
        if batch:
            files.write_ledger(df, src, batch)
        stream.follow(spark, src, "subject_id string, status string", out, chk).awaitTermination()
        assert spark.read.parquet(out).count() == n
    m = spark.createDataFrame([("a",), ("b",), ("c",)], "subject_id string")
    assert sorted(r.subject_id for r in stream.remaining(m, spark.read.parquet(out)).collect()) == ["b", "c"]


def test_region_checks_and_redaction(spark):
    g = np.random.default_rng(0)
    page = g.integers(0, 256, (120, 140), np.uint8)
    pages = spark.createDataFrame([("s", 1, "q", 120, 140, 1, bytearray(np.roll(page, (2, 3), (0, 1)).tobytes()))], "subject_id string, page_no long, template string, height int, width int, channels int, data binary")
    templates = spark.createDataFrame([("q", 120, 140, 1, bytearray(page.tobytes()))], "template string, t_height int, t_width int, t_channels int, t_data binary")
    b = spark.createDataFrame([("q", 0, 40, 40, 70, 70)], "template string, pos long, xtl long, ytl long, xbr long, ybr long")
    r = redact.region_checks(pages, templates, b, ["subject_id", "page_no"]).first()
    assert r.matched and (r.shift_x, r.shift_y) == (3.0, 2.0)
    pt = "array<struct<x:double,y:double>>"
    plan = spark.createDataFrame([("s", 1, [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)], None, False)], f"subject_id string, page_no long, points {pt}, bound {pt}, striped boolean")
    img = kernels.read_png(redact.redacted(pages, plan, ["subject_id", "page_no"]).first().png)
    assert (img[:10, :10] == 0).all() and (img[20:, 20:] == np.roll(page, (2, 3), (0, 1))[20:, 20:]).all()


def test_page_outcomes_as_text(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "omit"), ("b", 1, 'say "x"')], "subject_id string, page_no int, action string")
    got = {r.subject_id: json.loads(r.text) for r in ledger.page_outcome_text(df).collect()}
    assert got == {"a": [{"page_no": 1, "action": "omit"}, {"page_no": 2, "action": None}], "b": [{"page_no": 1, "action": 'say "x"'}]}


def test_quads_stretch_along_their_own_axes(spark):
    q = [(10.0, 0.0), (20.0, 10.0), (10.0, 20.0), (0.0, 10.0)]  # a square on its corner
    df = spark.createDataFrame([(0, [{"x": x, "y": y} for x, y in q])], "k int, q array<struct<x:double,y:double>>")
    move = lambda *a: [(round(p.x, 6), round(p.y, 6)) for p in df.select(boxes.stretch_quad(F.col("q"), *map(F.lit, a)).alias("o")).first().o]
    r = 2**0.5
    assert move(0.5, 0.0, 0.0) == q
    assert move(1.0, r, 0.0) == [(10, 0), (21, 11), (11, 21), (0, 10)]
    assert move(1.0, -r, r) == [(9, -1), (20, 10), (9, 21), (-2, 10)]
    assert move(2.0, 0.0, 0.0) == [(10, -10), (30, 10), (10, 30), (-10, 10)]
