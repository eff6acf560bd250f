"""Features of templates' boxes and of pages, and pages matched by keypoints and regions.

Images are prepared and described where they are decoded, in one Arrow pass; what comes out is small rows that joins and
CASEs work on. Nothing here moves pixels through a shuffle but the pairs that a join of pages and templates asks for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.functions import kernels
from veilframe.operators import boxes as B
from veilframe.operators.decide import transform_choice
from veilframe.sources.adapters import as_array

#: Fixed: what is kept of each kind of box, and of a page.
KINDS = {"align": ("keypoints", "full"), "blank": ("components", "black"), "standard": ("keypoints", "full"), "text": ("keypoints", "full"), "ocr": ("full",), "page": ("bits", "keypoints")}
#: Side of a keypoint's patch, and corner threshold, in a region and on a page.
REGION, PAGE = (15, 5), (31, 20)
#: All features that can be asked for, as columns; those not asked for are null.
COLUMNS = {"crc": "crc long", "bits": "bits long", "profile": "profile_x array<float>, profile_y array<float>", "components": "components long", "black": "black long", "keypoints": "points array<double>, descriptors binary", "full": "f_height int, f_width int, f_data binary"}
NAMES = [c.split()[0] for d in COLUMNS.values() for c in d.split(", ")]


class Once:
    """What a function gives for equal inputs, worked out once in a task; `most` bytes of results stay, by the inputs' digests."""

    def __init__(self, most: int = 32_000_000):
        self.most, self.held, self.size = most, {}, 0

    def __call__(self, parts: list, size: Callable[[object], int], work: Callable[[], object]):
        """parts: bytes, or what repr tells apart, that the result depends on alone; size: bytes of a result."""
        key = hashlib.blake2b(digest_size=32)
        for p in parts:
            p = p if isinstance(p, (bytes, bytearray, memoryview)) else repr(p).encode()
            key.update(len(p).to_bytes(8, "little"))
            key.update(p)
        key = key.digest()
        if key not in self.held:
            found = work()
            if self.size > self.most:
                self.held, self.size = {}, 0
            self.held[key] = found
            self.size += 1000 + size(found)
        return self.held[key]


def prepare(img: np.ndarray, box=None, kind: str = "standard", size: tuple[int, int] | None = None) -> np.ndarray:
    """A box's part of a page in grey: blank parts in black and white, parts for OCR doubled, smoothed and thresholded.

    box: left, top, right, bottom, or four corners of a quadrilateral, which is set upright; without one the whole image. A
    quadrilateral without an area gives an empty image.
    """
    if box is not None:
        b = np.asarray(box, float)
        if b.ndim == 2 and abs((b[2, 0] - b[0, 0]) * (b[3, 1] - b[1, 1]) - (b[2, 1] - b[0, 1]) * (b[3, 0] - b[1, 0])) < 1e-9:
            img = img[:0, :0]
        elif b.ndim == 2:
            wide, high = (int(round(max(np.hypot(*(b[j] - b[i])), np.hypot(*(b[m] - b[k]))))) for i, j, k, m in ((0, 1, 3, 2), (0, 3, 1, 2)))
            img = kernels.crop_rectified(img, b, (max(1, wide), max(1, high)))
        else:
            img = kernels.crop(img, box)
    g = kernels.gray(img)
    if g.size == 0:
        return g
    if kind == "blank":
        return kernels.binarise(g, 128)
    if kind == "ocr":
        big = kernels.scale(g, 2, kind="cubic")
        return kernels.adaptive_threshold(np.rint(kernels.blur(big, [1, 4, 6, 4, 1])).astype(np.uint8), 11, 2)
    return kernels.resize(g, size, "area") if size else g


def prepare_page(img: np.ndarray, part: str = "all", border: float = 0.0, two_levels: bool = False) -> np.ndarray:
    """A page in grey, or by Otsu's level in black and white: all of it, its upper third ("up"), or without its "borders"."""
    g = kernels.gray(img[: img.shape[0] // 3] if part == "up" else kernels.crop_borders(img, border) if part == "borders" else img)
    return kernels.binarise(g, kernels.otsu(g)) if two_levels else g


def describe(img: np.ndarray, want: tuple[str, ...], page: bool = False, border: float = 0.0) -> dict:
    """The features wanted of a prepared image, by COLUMNS; keypoints are empty where there are none."""
    out = dict.fromkeys(NAMES)
    unknown = set(want) - set(COLUMNS)
    if unknown:
        raise ValueError(f"no such features: {sorted(unknown)}")
    if img.size == 0:
        return out
    for w in want:
        if w == "crc":
            out["crc"] = kernels.checksum(img)
        elif w == "bits":
            out["bits"] = kernels.pack_bits(kernels.page_hash(img, border) if page else kernels.roi_hash(img))
        elif w == "profile":
            out["profile_x"], out["profile_y"] = kernels.profile(img, 0), kernels.profile(img, 1)
        elif w == "components":
            out["components"] = kernels.count_components(img)
        elif w == "black":
            out["black"] = kernels.count_black(img)
        elif w == "keypoints":
            patch, threshold = PAGE if page else REGION
            p, d = kernels.keypoints(img, 2000 if page else 500, patch, threshold=threshold)
            out["points"], out["descriptors"] = p.ravel(), d.tobytes()
        else:
            out |= {"f_height": img.shape[0], "f_width": img.shape[1], "f_data": np.ascontiguousarray(img).tobytes()}
    return out


BOX = ("pos", "kind", "xtl", "ytl", "xbr", "ybr")


def listed_boxes(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, boxes: each page's boxes as an array, to be joined to pages before they are decoded, or by template_features."""
    return boxes.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*BOX))).alias("boxes"))


def template_features(pages: DataFrame, boxes: DataFrame | None, keys: list[str], border: float = 0.0, kinds: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """keys, pos, kind and the features of each box of a template page, and of the page itself (pos -1).

    pages: keys and an image; boxes: keys, pos, kind, xtl, ytl, xbr, ybr. A kind that isn't in `kinds` has no features. An
    alignment box without any keypoint is an error, as no page could ever be matched by it. Pages without boxes have their
    own row alone. Without a table of them, pages may hold their `listed_boxes`; then nothing is joined and no pixels are
    shuffled. Pages with equal pixels and boxes are described once in a task.
    """
    kinds = kinds or KINDS
    x = pages if boxes is None else pages.drop("boxes").join(listed_boxes(boxes, keys), keys, "left")

    def of_page(r: dict, boxes: list[tuple]) -> list[list]:
        img, rows = as_array(r["height"], r["width"], r["channels"], r["data"]), []
        for pos, kind, *box in boxes:
            found = describe(prepare(img, box, kind), kinds.get(kind, ()))
            if kind == "align" and not found["descriptors"]:
                raise ValueError(f"no keypoints in the alignment box {pos} of {[r[k] for k in keys]}")
            rows.append([pos, kind, *found.values()])
        return [*rows, [-1, "page", *describe(prepare_page(img), kinds["page"], True, border).values()]]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once, size = Once(), lambda rows: sum(8 * len(v) if isinstance(v, np.ndarray) else len(v) for row in rows for v in row if hasattr(v, "__len__"))
        for f in frames:
            rows = []
            for r in f.to_dict("records"):
                own, b = [r[k] for k in keys], r.get("boxes")
                b = [tuple(x[c] for c in BOX) for x in b] if b is not None else []
                found = once([r["data"], (r["height"], r["width"], r["channels"]), b], size, lambda: of_page(r, b))  # noqa: B023
                rows += [[*own, *row] for row in found]
            yield pd.DataFrame(rows, columns=[*keys, "pos", "kind", *NAMES])

    schema = ", ".join([*(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keys), "pos long, kind string", *COLUMNS.values()])
    return x.mapInPandas(run, schema)


# --- keypoints --------------------------------------------------------------------------------------------------------
def fit_similarity(src, dst, threshold: float = 5.0, rounds: int = 200, seed: int = 0) -> tuple[complex, complex] | None:
    """Turn-and-scale m and shift t with dst = m src + t (points as complex numbers), from pairs of a seeded generator, refitted
    to the pairs it brings within the threshold."""
    a, b = (np.asarray(p, float).reshape(-1, 2) @ [1, 1j] for p in (src, dst))
    best = np.zeros(len(a), bool)
    for pairs in kernels.draws(len(a), 2, rounds if len(a) >= 2 else 0, seed):
        i, j = pairs[a[pairs[:, 0]] != a[pairs[:, 1]]].T[:, :, None]
        m = (b[i] - b[j]) / (a[i] - a[j])
        near = np.abs(m * (a - a[i]) + b[i] - b) < threshold
        k = int(near.sum(1).argmax()) if len(near) else None
        if k is not None and near[k].sum() > best.sum():
            best = near[k]
        if best.all():
            break
    if best.sum() < 2:
        return None
    x, y = a[best] - a[best].mean(), b[best] - b[best].mean()
    m = (x.conj() @ y) / (x.conj() @ x).real
    return m, b[best].mean() - m * a[best].mean()


def match_keypoints(page: tuple, template: tuple, how: str = "best_n", decision: str = "simple", estimate: str = "center_of_mass", least: int = 10, ratio: float = 0.7, n: int = 50, offset: tuple[float, float] = (0.0, 0.0)) -> dict:
    """matched, n_good, reason, shift_x, shift_y, scale, degrees, homography (nine values) of a page's points on a template's.

    page, template: points (rows of x, y, angle) and descriptors. how: as kernels.match_descriptors; by "best_n" all mutual
    pairs count, though only the n best are fitted. decision: simple (more than `least` pairs), homography (`least` inliers
    and three tenths of the pairs) or geometric (a homography exists; whether it's a sound one, say its values). estimate:
    center_of_mass, affine or homography. offset is taken off shifts. Without descriptors there's a reason and no match.
    """
    (pp, pd_), (tp, td) = page, template
    out = {"matched": False, "n_good": 0, "reason": None, "shift_x": None, "shift_y": None, "scale": None, "degrees": None, "homography": None}
    lacking = [f"{side} has no descriptors" for side, d in (("page", pd_), ("template", td)) if d is None or not len(d)]
    if lacking:
        return out | {"reason": ", ".join(lacking)}
    if pd_.shape[1] != td.shape[1]:
        return out | {"reason": f"descriptors of {pd_.shape[1]} and {td.shape[1]} bytes"}
    pairs = kernels.match_descriptors(pd_, td, "all" if how == "best_n" else how, ratio=ratio)
    out["n_good"], pairs = len(pairs), pairs[:n] if how == "best_n" else pairs
    a, b = np.array([tp[j][:2] for _, j, _ in pairs], float).reshape(-1, 2), np.array([pp[i][:2] for i, _, _ in pairs], float).reshape(-1, 2)
    homography = None
    if decision != "simple" or estimate == "homography":
        if len(pairs) < 4:
            return out | {"reason": "fewer than 4 pairs"}
        homography, inside = kernels.ransac_homography(a, b)
        if homography is None:
            return out | {"reason": "no homography"}
        homography = homography / homography[2, 2]
        out["homography"] = homography.ravel().tolist()
    if decision == "simple":
        out["matched"] = out["n_good"] > least
    elif decision == "homography":
        out["matched"] = bool(inside.sum() >= least and inside.sum() >= 0.3 * len(pairs))
    else:
        out["matched"] = True
    if not out["matched"]:
        return out | {"reason": "too few pairs"}
    if estimate == "center_of_mass":
        x, y = b.mean(0) - a.mean(0) - offset
        return out | {"shift_x": float(x), "shift_y": float(y), "scale": 1.0, "degrees": 0.0}
    if estimate == "affine":
        found = fit_similarity(a, b)
        if found is None:
            return out | {"matched": False, "reason": "no affine fit"}
        m, t = found
        return out | {"shift_x": float(t.real - offset[0]), "shift_y": float(t.imag - offset[1]), "scale": float(abs(m)), "degrees": float(np.degrees(np.angle(m)))}
    return out


FOUND = "matched boolean, n_good long, reason string, shift_x double, shift_y double, scale double, degrees double, homography array<double>"


def keypoint_matches(pairs: DataFrame, keys: list[str], **how) -> DataFrame:
    """keys and what match_keypoints finds, for rows of points, descriptors and t_points, t_descriptors; `how` is its settings.

    Pairs of equal points and descriptors are matched once in a task. With decision="geometric" a pair is matched only if its homography takes a square to nearly one, else that's the reason.
    """

    def side(points, descriptors):
        if points is None or descriptors is None:
            return np.zeros((0, 3)), np.zeros((0, 32), np.uint8)
        return np.asarray(points, float).reshape(-1, 3), np.frombuffer(descriptors, np.uint8).reshape(-1, 32)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once = Once()
        for f in frames:
            found = []
            for row in zip(f["points"], f["descriptors"], f["t_points"], f["t_descriptors"], strict=True):
                page, template = side(*row[:2]), side(*row[2:])
                parts = [v for p, d in (page, template) for v in (np.ascontiguousarray(p).tobytes(), d.tobytes())]
                found.append(once(parts, lambda x: 500, lambda: match_keypoints(page, template, **how)))  # noqa: B023
            names = [c.split()[0] for c in FOUND.split(", ")]
            yield pd.concat([f[keys].reset_index(drop=True), pd.DataFrame(found, columns=names)], axis=1)

    schema = ", ".join([*(f"`{k}` {pairs.schema[k].dataType.simpleString()}" for k in keys), FOUND])
    out = pairs.select(*keys, "points", "descriptors", "t_points", "t_descriptors").mapInPandas(run, schema)
    if how.get("decision") != "geometric":
        return out
    probe = B.Box(F.lit(0.0), F.lit(0.0), F.lit(100.0), F.lit(100.0))
    sound = F.when(F.col("matched"), B.validity(B.project_homography(probe, F.col("homography"))))
    return out.withColumn("__sound", sound).withColumn("reason", F.when(F.col("matched") & ~F.col("__sound.ok"), F.col("__sound.reason")).otherwise(F.col("reason"))).withColumn("matched", F.coalesce(F.col("matched") & F.col("__sound.ok"), F.lit(False))).drop("__sound")


# --- transforms -------------------------------------------------------------------------------------------------------
def page_transforms(regions: DataFrame, affine: DataFrame, homography: DataFrame, keys: list[str]) -> DataFrame:
    """keys, method, scale, shift_x, shift_y, degrees, homography of each page that one of the three tables has.

    Two matched regions (rows of keys, matched, shift_x, shift_y) give their mean shift; else a sound affine fit counts, else
    a homography, both as keypoint_matches gives them; else the method failed, with scale -1.
    """
    r = regions.groupBy(*keys).agg(F.count_if("matched").alias("n_shifts"), *(F.avg(F.when(F.col("matched"), F.col(c))).alias(f"r_{c}") for c in ("shift_x", "shift_y")))
    a = affine.select(*keys, F.col("matched").alias("affine_ok"), *(F.col(c).alias(f"a_{c}") for c in ("shift_x", "shift_y", "scale", "degrees")))
    h = homography.select(*keys, F.col("matched").alias("homography_ok"), "homography")
    x = r.join(a, keys, "full").join(h, keys, "full").fillna({"n_shifts": 0, "affine_ok": False, "homography_ok": False})
    by = transform_choice(x.withColumn("scale", F.when((F.col("n_shifts") < 2) & F.col("affine_ok"), F.col("a_scale")).otherwise(F.lit(1.0))))
    pick = lambda c: F.when(F.col("method") == "pre_computed", F.col(f"r_{c}")).when(F.col("method") == "orb_page_level_affine", F.col(f"a_{c}")).alias(c)
    degrees = F.when(F.col("method") == "pre_computed", F.lit(0.0)).when(F.col("method") == "orb_page_level_affine", F.col("a_degrees"))
    return by.select(*keys, "method", "scale", pick("shift_x"), pick("shift_y"), degrees.alias("degrees"), F.when(F.col("method") == "orb_page_level_homography", F.col("homography")).alias("homography"))
