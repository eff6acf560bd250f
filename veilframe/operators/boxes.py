"""Boxes as columns xtl, ytl, xbr, ybr (or any four columns), polygons as arrays of points: geometry in column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.operators.vectors import let


@dataclass(frozen=True)
class Box:
    """Four coordinates as column expressions."""

    xtl: Column
    ytl: Column
    xbr: Column
    ybr: Column

    @classmethod
    def of(cls, prefix: str = "") -> Box:
        return cls(*[F.col(f"{prefix}{c}") for c in ("xtl", "ytl", "xbr", "ybr")])

    def each(self, f) -> Box:
        return Box(*map(f, (self.xtl, self.ytl, self.xbr, self.ybr)))

    def columns(self, prefix: str = "") -> list[Column]:
        return [c.alias(f"{prefix}{n}") for c, n in zip((self.xtl, self.ytl, self.xbr, self.ybr), ("xtl", "ytl", "xbr", "ybr"), strict=True)]

    @property
    def width(self) -> Column:
        return self.xbr - self.xtl

    @property
    def height(self) -> Column:
        return self.ybr - self.ytl

    def area(self) -> Column:
        return F.abs(self.width * self.height)

    def positive_area(self) -> Column:
        """Zero for an inverted side."""
        return F.greatest(self.width, F.lit(0)) * F.greatest(self.height, F.lit(0))


def from_percent(x: Column, y: Column, w: Column, h: Column, page_w: Column, page_h: Column) -> Box:
    """Pixels from percents of the page."""
    return Box(x / 100.0 * page_w, y / 100.0 * page_h, (x + w) / 100.0 * page_w, (y + h) / 100.0 * page_h)


def rescale(b: Box, from_w: Column, from_h: Column, to_w: Column, to_h: Column) -> Box:
    """Between resolutions; each coordinate loses its fraction, towards zero."""
    sx, sy = to_w / from_w, to_h / from_h
    return Box((b.xtl * sx).cast("int"), (b.ytl * sy).cast("int"), (b.xbr * sx).cast("int"), (b.ybr * sy).cast("int"))


def enlarge(b: Box, factor: float, page_w: Column, page_h: Column) -> Box:
    """About its centre; what a page's border cuts off is added on the other side, then all is cut at the border, to integers."""

    def side(lo: Column, hi: Column, most: Column) -> tuple[Column, Column]:
        middle, half = lo + (hi - lo) / 2, (hi - lo) * F.lit(float(factor)) / 2
        a, z = middle - half, middle + half
        return F.greatest(a - F.greatest(z - most, F.lit(0)), F.lit(0)).cast("int"), F.least(z + F.greatest(-a, F.lit(0)), most).cast("int")

    (x0, x1), (y0, y1) = side(b.xtl, b.xbr, page_w), side(b.ytl, b.ybr, page_h)
    return Box(x0, y0, x1, y1)


def snap(b: Box, old_w: Column, old_h: Column, new_w: Column, new_h: Column, eps: float = 2.0) -> Box:
    """Edges within eps of the old page's border move to the new page's."""

    def one(c: Column, old: Column, new: Column) -> Column:
        at_start = F.when(c <= eps, F.lit(0.0)).otherwise(c.cast("double"))
        return F.when(at_start >= old - eps, new.cast("double")).otherwise(at_start)

    return Box(one(b.xtl, old_w, new_w), one(b.ytl, old_h, new_h), one(b.xbr, old_w, new_w), one(b.ybr, old_h, new_h))


def clip(inner: Box, outer: Box) -> Box:
    """The inner box within the outer one; inverted where they don't meet."""
    return Box(F.greatest(inner.xtl, outer.xtl), F.greatest(inner.ytl, outer.ytl), F.least(inner.xbr, outer.xbr), F.least(inner.ybr, outer.ybr))


def stretch(b: Box, scale: Column, shift_x: Column, shift_y: Column) -> Box:
    """Grows about the centre (never shrinks), then one side follows each shift, by its sign; to integers."""
    s = F.greatest(scale, F.lit(1.0))
    cx, cy, w, h = b.xtl + b.width / 2, b.ytl + b.height / 2, b.width * s, b.height * s
    zero = F.lit(0)
    return Box(cx - w / 2 + F.least(shift_x, zero), cy - h / 2 + F.least(shift_y, zero), cx + w / 2 + F.greatest(shift_x, zero), cy + h / 2 + F.greatest(shift_y, zero)).each(lambda c: c.cast("int"))


def stretch_all(b: Box, scale: Column, shifts_x: Column, shifts_y: Column) -> Box:
    """By the largest and then the smallest of several shifts; by the shift where there is one."""
    first = stretch(b, scale, F.array_max(shifts_x), F.array_max(shifts_y))
    again = stretch(first, scale, F.array_min(shifts_x), F.array_min(shifts_y))
    one = F.size(shifts_x) > 1
    pick = lambda p, q: F.when(one, q).otherwise(p)
    return Box(pick(first.xtl, again.xtl), pick(first.ytl, again.ytl), pick(first.xbr, again.xbr), pick(first.ybr, again.ybr))


def stretch_quad(points: Column, scale: Column, shift_x: Column, shift_y: Column) -> Column:
    """A quad (top left, top right, bottom right, bottom left) that grows about its mean (never shrinks), then moves one side
    along its own axes by each shift: the right or left one by shift_x, the bottom or top one by shift_y, by their signs."""
    s, zero = F.greatest(scale.cast("double"), F.lit(1.0)), F.lit(0.0)
    at = lambda i, c: F.get(points, F.lit(i))[c]
    mean = {c: sum((at(i, c) for i in range(1, 4)), at(0, c)) / 4 for c in "xy"}
    big = [{c: mean[c] + (at(i, c) - mean[c]) * s for c in "xy"} for i in range(4)]

    def axis(i: int) -> dict[str, Column]:
        d = {c: big[i][c] - big[0][c] for c in "xy"}
        n = F.sqrt(d["x"] * d["x"] + d["y"] * d["y"])
        return {c: d[c] / n for c in "xy"}

    across, down = axis(1), axis(3)
    # by corner: whether it is on the right, and at the bottom
    sides = ((False, False), (True, False), (True, True), (False, True))
    moves = [((F.greatest if right else F.least)(shift_x, zero), (F.greatest if low else F.least)(shift_y, zero)) for right, low in sides]
    return F.array(*[point(*(big[i][c] + across[c] * moves[i][0] + down[c] * moves[i][1] for c in "xy")) for i in range(4)])


def center(b: Box) -> tuple[Column, Column]:
    return F.floor((b.xtl + b.xbr) / 2), F.floor((b.ytl + b.ybr) / 2)


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.sqrt(F.pow(x1 - x0, 2) + F.pow(y1 - y0, 2))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def polygon(b: Box) -> Column:
    """Corners: top left, top right, bottom right, bottom left."""
    return F.array(point(b.xtl, b.ytl), point(b.xbr, b.ytl), point(b.xbr, b.ybr), point(b.xtl, b.ybr))


def is_quad(points: Column) -> Column:
    return F.size(points) == 4


def bounds(points: Column) -> Box:
    """A polygon's axis-aligned box, to integers."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return Box(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)).each(lambda c: c.cast("int"))


def mean_point(points: Column) -> Column:
    """Mean of a polygon's points, to integers."""
    mean = lambda c: (F.aggregate(points, F.lit(0.0), lambda a, p: a + p[c]) / F.size(points)).cast("int")
    return F.struct(mean("x").alias("x"), mean("y").alias("y"))


def order_quad(points: Column) -> Column:
    """Four points as top left, top right, bottom right, bottom left, by sums and differences; the first of equal ones."""
    add, sub = (lambda p: p["x"] + p["y"]), (lambda p: p["y"] - p["x"])

    def at(score, sign: int) -> Column:
        keyed = F.transform(points, lambda p, i: F.struct((score(p) * sign).alias("k"), i.alias("i"), p.alias("p")))
        return F.array_min(keyed)["p"]

    return F.array(at(add, 1), at(sub, 1), at(add, -1), at(sub, -1))


def angle(a: Column, v: Column, b: Column) -> Column:
    """Degrees at v between a and b; 0 with a side of no length."""
    ax, ay, bx, by = a["x"] - v["x"], a["y"] - v["y"], b["x"] - v["x"], b["y"] - v["y"]
    n = F.sqrt(ax * ax + ay * ay) * F.sqrt(bx * bx + by * by)
    cos = F.when(n > 0, (ax * bx + ay * by) / n)
    return F.coalesce(F.degrees(F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cos)))), F.lit(0.0))


def rotate(p: Column, px: Column, py: Column, degrees: Column) -> Column:
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    return point(c * (p["x"] - px) - s * (p["y"] - py) + px, s * (p["x"] - px) + c * (p["y"] - py) + py)


def project_similar(b: Box, ref_x: Column, ref_y: Column, scale: Column, shift_x: Column, shift_y: Column, degrees: Column, inverse: bool = False, turn: bool = True) -> Column:
    """A box scaled about its centre, shifted, and turned about a reference point by minus the angle: its corners."""
    if inverse:
        scale, shift_x, shift_y, degrees = 1 / scale, -shift_x, -shift_y, -degrees
    cx, cy, w, h = (b.xtl + b.xbr) / 2 + shift_x, (b.ytl + b.ybr) / 2 + shift_y, b.width * scale, b.height * scale
    corners = polygon(Box(cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2))
    return F.transform(corners, lambda p: rotate(p, ref_x, ref_y, -degrees)) if turn else corners


def project_homography(b: Box, h: Column) -> Column:
    """A box's corners under a 3 x 3 matrix, given row by row as an array."""
    m = [h[k] for k in range(9)]

    def one(p: Column) -> Column:
        d = m[6] * p["x"] + m[7] * p["y"] + m[8]
        return point((m[0] * p["x"] + m[1] * p["y"] + m[2]) / d, (m[3] * p["x"] + m[4] * p["y"] + m[5]) / d)

    return F.transform(polygon(b), one)


def area_of(points: Column) -> Column:
    """A quadrilateral's area."""
    p = [points[k] for k in range(4)]
    return F.abs(sum((p[k]["x"] * p[(k + 1) % 4]["y"] - p[(k + 1) % 4]["x"] * p[k]["y"] for k in range(4)), F.lit(0.0))) / 2


def is_convex(points: Column) -> Column:
    """Whether a quadrilateral turns one way at all corners of its points without their fractions."""
    p = [(points[k]["x"].cast("int"), points[k]["y"].cast("int")) for k in range(4)]
    turns = []
    for k in range(4):
        (ax, ay), (bx, by), (cx, cy) = p[k - 1], p[k], p[(k + 1) % 4]
        turns.append((bx - ax) * (cy - by) - (by - ay) * (cx - bx))
    all_ = lambda f: f(turns[0]) & f(turns[1]) & f(turns[2]) & f(turns[3])
    return all_(lambda t: t > 0) | all_(lambda t: t < 0)


def validity(corners: Column, width: float = 100.0, height: float = 100.0, tolerance: float = 10.0, resize: float = 1.0) -> Column:
    """ok and reason of a transform, by where it takes the corners of a probe of the given size."""
    return let(corners, lambda c: _validity(c, width, height, tolerance, resize))


def _validity(corners: Column, width: float, height: float, tolerance: float, resize: float) -> Column:
    share = area_of(corners) / F.lit(width * height * resize)
    bad = F.lit(None).cast("string")
    for k in reversed(range(4)):
        a = angle(corners[(k - 1) % 4], corners[k], corners[(k + 1) % 4])
        bad = F.when(F.abs(a - 90) > tolerance, F.concat(F.lit(f"Bad angle at corner {k}: "), F.format_string("%.1f", a), F.lit(f"° (Target: 90°±{tolerance:g}°)"))).otherwise(bad)
    reason = F.when(~is_convex(corners), F.lit("Non-convex (bow-tie distortion)")).when((share < 0.4) | (share > 1.6), F.concat(F.lit("Area error: "), F.format_string("%.2f", share), F.lit("x size"))).otherwise(F.coalesce(bad, F.lit("Success")))
    return F.struct((reason == "Success").alias("ok"), reason.alias("reason"))


def smallest_containing(inner: DataFrame, outer: DataFrame, keys: list[str]) -> DataFrame:
    """Each inner box with the smallest outer box around it (touching counts), the first of equal ones; null without one.

    Both have the key columns, pos and a box. An equi join on the keys, with the containment as its condition.
    """
    o = outer.select(*[F.col(k).alias(f"o_{k}") for k in keys], F.col("pos").alias("outer_pos"), *Box.of().columns("o_"))
    b, c = Box.of(), Box.of("o_")
    on = (c.xtl <= b.xtl) & (c.ytl <= b.ytl) & (c.xbr >= b.xbr) & (c.ybr >= b.ybr)
    for k in keys:
        on = on & (F.col(k) == F.col(f"o_{k}"))
    x = inner.join(o, on, "left")
    best = F.min(F.when(F.col("outer_pos").isNotNull(), F.struct(c.area().alias("area"), F.col("outer_pos").alias("pos"))))
    return x.groupBy(*keys, "pos").agg(best["pos"].alias("outer_pos"))


def coverage(inner: DataFrame, outer: DataFrame, keys: list[str], threshold: float = 0.5) -> DataFrame:
    """keys, inner_pos, outer_pos, coverage, is_partial (the outer's): pairs that share so much of the inner box's area."""
    o = outer.select(*[F.col(k).alias(f"o_{k}") for k in keys], F.col("pos").alias("outer_pos"), F.col("is_partial"), *Box.of().columns("o_"))
    i = inner.select(*keys, F.col("pos").alias("inner_pos"), *Box.of().columns())
    b, c = Box.of(), Box.of("o_")
    share = F.when(b.area() > 0, clip(b, c).positive_area() / b.area()).otherwise(F.lit(0.0))
    on = share >= threshold
    for k in keys:
        on = on & (F.col(k) == F.col(f"o_{k}"))
    return i.join(o, on).select(*keys, "inner_pos", "outer_pos", F.round(share, 6).alias("coverage"), "is_partial")


def stripe_plan(extent: Column, page_w: float, page_frac: float = 0.04, area_frac: float = 2 / 3) -> Column:
    """Stripes along an extent, as an array of start and stop: blocks as wide as leaves page_frac of the page white in each; the
    last stripe ends with the extent."""
    block = page_w * page_frac / (1 - area_frac)
    thick = block * area_frac
    n = F.ceil(extent / F.lit(block)).cast("int")
    return F.transform(F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: i < n), lambda i: F.struct((i * F.lit(block)).alias("start"), F.least(i * F.lit(block) + F.lit(thick), extent).alias("stop")))


def fit_similarity(points: Column, selection: str = "top_left") -> Column:
    """Scale, shift, degrees and reference of a similarity from an array of cx, cy, sx, sy: centres and their shifts.

    Two centres decide: the nearest to the origin and the furthest from it ("top_left"), the furthest from the origin instead
    ("origin"), or the two furthest apart ("most_distant"). The shift is always the first element's. Fewer than two, or no
    second centre apart from the first, give the identity. A turn by a right angle is found, as slopes are taken by atan2.
    """
    away = lambda p, q: (p["cx"] - q["cx"]) * (p["cx"] - q["cx"]) + (p["cy"] - q["cy"]) * (p["cy"] - q["cy"])
    origin = F.struct(F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"))
    if selection == "most_distant":
        pairs = F.flatten(F.transform(points, lambda p, i: F.transform(points, lambda q, j: F.struct((-away(p, q)).alias("k"), i.alias("i"), j.alias("j"), p.alias("p"), q.alias("q")))))
        best = F.array_min(F.filter(pairs, lambda x: x["i"] < x["j"]))
        one, two = best["p"], best["q"]
    else:
        one = F.array_min(F.transform(points, lambda p, i: F.struct(away(p, origin).alias("k"), i.alias("i"), p.alias("p"))))
        at = origin if selection == "origin" else one["p"]
        rest = F.filter(F.transform(points, lambda p, i: F.struct((-away(p, at)).alias("k"), i.alias("i"), p.alias("p"))), lambda x: x["i"] != one["i"])
        one, two = one["p"], F.array_min(rest)["p"]
    dx, dy = two["cx"] - one["cx"], two["cy"] - one["cy"]
    ex, ey = dx + two["sx"] - one["sx"], dy + two["sy"] - one["sy"]
    before = F.sqrt(dx * dx + dy * dy)
    turn = F.degrees(F.atan2(ex, ey) - F.atan2(dx, dy))
    turn = turn - 180 * F.round(turn / 180)  # as slopes, not directions
    fit = lambda s, x, y, t, rx, ry: F.struct(s.alias("scale"), x.alias("shift_x"), y.alias("shift_y"), t.alias("degrees"), rx.alias("ref_x"), ry.alias("ref_y"))
    fewer = fit(*[F.lit(v) for v in (1.0, 0.0, 0.0, 0.0, 0.0, 0.0)])
    found = fit(F.sqrt(ex * ex + ey * ey) / before, points[0]["sx"].cast("double"), points[0]["sy"].cast("double"), turn, one["cx"].cast("double"), one["cy"].cast("double"))
    return F.when((F.size(points) >= 2) & (before > 0), found).otherwise(fewer)


def variant_by_aspect(pages: DataFrame, id_: str = "subject_id", tolerance: float = 0.1) -> DataFrame:
    """variant 2 for subjects with a page that is almost square, else 1."""
    square = F.abs(F.col("width") - F.col("height")) / F.greatest("width", "height") < tolerance
    return pages.groupBy(id_).agg(F.when(F.bool_or(square), 2).otherwise(1).alias("variant"))
