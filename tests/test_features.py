"""Template features and keypoint matches on images whose answers are known."""

import numpy as np
import pytest

from veilframe.functions import kernels
from veilframe.operators import features as feats

RNG = np.random.default_rng(3)
TEXTURE = RNG.integers(0, 256, (24, 24)).astype(np.uint8).repeat(8, 0).repeat(8, 1)


def points(img):
    return kernels.keypoints(img, 2000)


def moved(dx, dy):
    return TEXTURE[20 - dy : 170 - dy, 20 - dx : 170 - dx]


@pytest.mark.parametrize("how", ["best_n", "all", "lowe_ratio"])
@pytest.mark.parametrize("decision", ["simple", "homography", "geometric"])
def test_shift_by_every_filter_and_decision(how, decision):
    got = feats.match_keypoints(points(moved(5, -3)), points(moved(0, 0)), how, decision, estimate="affine", offset=(1, 1))
    assert got["matched"] and got["shift_x"] == pytest.approx(4, abs=0.1) and got["shift_y"] == pytest.approx(-4, abs=0.1)
    assert got["scale"] == pytest.approx(1, abs=0.01) and got["degrees"] == pytest.approx(0, abs=0.2)


def test_no_match_says_why():
    some, none = points(moved(0, 0)), (np.zeros((0, 3)), np.zeros((0, 32), np.uint8))
    assert feats.match_keypoints(none, some)["reason"] == "page has no descriptors"
    assert feats.match_keypoints((None, None), none)["reason"] == "page has no descriptors, template has no descriptors"
    assert feats.match_keypoints((some[0], some[1][:, :16]), some)["reason"] == "descriptors of 16 and 32 bytes"
    few = (some[0][:3], some[1][:3])
    assert feats.match_keypoints(few, some)["reason"] == "too few pairs"
    assert feats.match_keypoints(few, some, decision="homography")["reason"] == "fewer than 4 pairs"
    assert not feats.match_keypoints(few, some, "distance_threshold")["matched"]
    # all mutual pairs count for the decision, the n best for the fit
    assert feats.match_keypoints(some, some, n=5, least=20)["matched"]


def test_similarity_is_found_among_outliers():
    a = RNG.uniform(0, 100, (40, 2))
    m, t = 1.2 * np.exp(0.3j), 7 - 4j
    z = m * (a @ [1, 1j]) + t
    b = np.column_stack([z.real, z.imag])
    b[::4] += RNG.uniform(50, 90, b[::4].shape)
    got = feats.fit_similarity(a, b)
    assert got[0] == pytest.approx(m, abs=1e-9) and got[1] == pytest.approx(t, abs=1e-7)
    assert feats.fit_similarity([], []) is None and feats.fit_similarity([(1, 1)] * 3, [(2, 2)] * 3) is None


def test_preparations():
    img = np.full((60, 90), 255, np.uint8)
    img[10:20, 10:30] = 0
    assert feats.prepare(img, (5, 5, 45, 35)).shape == (30, 40) and feats.prepare(img, (5, 5, 45, 35), size=(16, 8)).shape == (8, 16)
    assert set(np.unique(feats.prepare(img // 2, (5, 5, 45, 35), "blank"))) <= {0, 255}
    assert feats.prepare(img, (5, 5, 45, 35), "ocr").shape == (60, 80)
    quad = [(9, 9), (30, 9), (30, 20), (9, 20)]
    assert kernels.count_black(feats.prepare(img, quad)) == pytest.approx(200, abs=30)
    assert feats.prepare(img, [(5, 5)] * 4).size == 0 and feats.prepare(img, (100, 100, 120, 120), "ocr").size == 0
    assert feats.prepare_page(img, "up").shape == (20, 90) and feats.prepare_page(img, "borders", 0.1).shape == (48, 72)
    assert set(np.unique(feats.prepare_page(img, two_levels=True))) == {0, 255}
    every = feats.describe(img, tuple(feats.COLUMNS))
    assert every["black"] == 200 and every["components"] == 1 and len(every["f_data"]) == 60 * 90
    assert all(v is None for v in feats.describe(img[:0], ("black", "keypoints")).values())
    with pytest.raises(ValueError, match="no such features"):
        feats.describe(img, ("colour",))


def test_template_features_of_odd_tables(spark):
    white = bytearray(np.full((40, 40), 255, np.uint8).tobytes())
    pages = spark.createDataFrame([(1, 40, 40, 1, white), (2, 40, 40, 1, white)], "k long, height int, width int, channels int, data binary")
    kinds = "k long, pos long, kind string, xtl int, ytl int, xbr int, ybr int"
    boxes = spark.createDataFrame([(1, 0, "blank", 0, 0, 10, 10), (1, 1, "other", 0, 0, 10, 10), (1, 2, "blank", 90, 90, 99, 99), (9, 0, "blank", 0, 0, 9, 9)], kinds)
    got = {(r.k, r.pos): r for r in feats.template_features(pages, boxes, ["k"]).collect()}
    assert sorted(got) == [(1, -1), (1, 0), (1, 1), (1, 2), (2, -1)]
    assert got[1, 0].black == 0 and got[1, 1].black is None and got[1, 2].black is None and got[2, -1].bits is not None
    assert feats.template_features(pages.limit(0), boxes, ["k"]).count() == 0
    with pytest.raises(Exception, match="no keypoints in the alignment box"):
        feats.template_features(pages, spark.createDataFrame([(1, 0, "align", 0, 0, 30, 30)], kinds), ["k"]).collect()


def test_pages_are_not_what_is_broadcast(spark):
    from veilframe.plans import raster_queries

    plan = raster_queries.region_misalignment(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan and "leftHint" not in plan


def test_search_ends_with_what_cannot_be_bettered(monkeypatch):
    a, b = points(moved(5, -3)), points(moved(0, 0))
    solved, svd = [], np.linalg.svd
    monkeypatch.setattr(np.linalg, "svd", lambda x, *how: solved.append(np.prod(x.shape[:-2])) or svd(x, *how))
    got = feats.match_keypoints(a, b, decision="geometric", estimate="homography")
    assert got["homography"][2] == pytest.approx(5, abs=1e-6) and sum(solved) < 100
    rng = np.random.default_rng(4)
    assert np.concatenate(list(kernels.draws(9, 4, 50, 4))).tolist() == [rng.choice(9, 4, replace=False).tolist() for _ in range(50)]
    # with outliers all rounds are drawn, and the best is the first of the best
    src = RNG.uniform(0, 100, (30, 2))
    dst = src + 4
    dst[:15] = RNG.uniform(200, 900, (15, 2))
    assert kernels.ransac_homography(src, dst)[1].tolist() == [False] * 15 + [True] * 15


def test_equal_inputs_are_worked_out_once():
    done, once = [], feats.Once(most=2500)
    ask = lambda *parts: once(list(parts), lambda x: 0, lambda: done.append(parts) or len(done))
    assert [ask(b"ab", (1, 2)), ask(b"ab", (2, 1)), ask(b"a", b"b"), ask(b"ab", (1, 2)), ask(b"a", b"b")] == [1, 2, 3, 1, 3]
    assert ask(b"new") == 4 and len(once.held) == 1 and ask(b"ab", (1, 2)) == 5  # what is held is bounded


def test_pages_of_equal_pixels_keep_their_own_boxes_and_shapes(spark):
    data = bytearray(np.ascontiguousarray(moved(0, 0)).tobytes())
    schema = "k long, height int, width int, channels int, data binary"
    pages = spark.createDataFrame([(1, 150, 150, 1, data), (2, 150, 150, 1, data), (3, 100, 225, 1, data), (4, 150, 150, 1, data)], schema).coalesce(1)
    boxes = spark.createDataFrame([(k, 0, "ocr", 10, 5, 40 + (k == 4), 25) for k in (1, 3, 4)], "k long, pos long, kind string, xtl int, ytl int, xbr int, ybr int")
    joined = feats.template_features(pages, boxes, ["k"])
    got = {(r.k, r.pos): r for r in joined.collect()}
    assert sorted(got) == [(1, -1), (1, 0), (2, -1), (3, -1), (3, 0), (4, -1), (4, 0)]
    assert got[1, -1].descriptors == got[2, -1].descriptors == feats.describe(moved(0, 0), ("keypoints",), True)["descriptors"] != got[3, -1].descriptors
    assert (got[1, 0].f_width, got[4, 0].f_width) == (60, 62) and got[1, 0].f_data != got[3, 0].f_data
    held = feats.template_features(pages.join(feats.listed_boxes(boxes, ["k"]), "k", "left"), None, ["k"])
    assert sorted(map(str, held.collect())) == sorted(map(str, joined.collect()))


def test_pages_are_not_joined_with_no_boxes(spark):
    from veilframe.plans import raster_queries

    plan = raster_queries.keypoint_match(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan


def test_boxes_are_joined_before_pages_are_drawn(spark):
    from veilframe.plans import raster_queries

    plan = raster_queries.template_features(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 2 and plan.rindex("MapInPandas") < plan.index("Join LeftOuter")
