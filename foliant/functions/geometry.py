"""Boxes `struct<xtl,ytl,xbr,ybr>` and corner lists `array<struct<x,y>>` as column expressions; pixels grow to the right and down."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDES = ("xtl", "ytl", "xbr", "ybr")


def box(xtl: Column, ytl: Column, xbr: Column, ybr: Column, kind: str = "double") -> Column:
    return F.struct(*(c.cast(kind).alias(n) for c, n in zip((xtl, ytl, xbr, ybr), SIDES, strict=True)))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def width(b: Column) -> Column:
    return b["xbr"] - b["xtl"]


def height(b: Column) -> Column:
    return b["ybr"] - b["ytl"]


def area(b: Column) -> Column:
    return F.greatest(width(b), F.lit(0)) * F.greatest(height(b), F.lit(0))


def center(b: Column) -> Column:
    """Whole pixels, rounded down."""
    return point(F.floor((b["xtl"] + b["xbr"]) / 2), F.floor((b["ytl"] + b["ybr"]) / 2))


def distance(a: Column, b: Column) -> Column:
    return F.hypot(a["x"] - b["x"], a["y"] - b["y"])


def polygon(b: Column) -> Column:
    """The four corners from the top left, clockwise."""
    return F.array(point(b["xtl"], b["ytl"]), point(b["xbr"], b["ytl"]), point(b["xbr"], b["ybr"]), point(b["xtl"], b["ybr"]))


def bounds(pts: Column) -> Column:
    """The upright box of a corner list, cut to whole pixels."""
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return box(*(c.cast("int") for c in (F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))))


def ordered_quad(pts: Column) -> Column:
    """Corners as top left, top right, bottom right, bottom left: by least and greatest sum and difference of coordinates."""
    plus, minus = F.transform(pts, lambda p: p["x"] + p["y"]), F.transform(pts, lambda p: p["y"] - p["x"])
    at = lambda v, best: F.get(pts, F.array_position(v, best(v)) - 1)
    return F.array(at(plus, F.array_min), at(minus, F.array_min), at(plus, F.array_max), at(minus, F.array_max))


def from_percent(b: dict[str, Column], page_width: Column, page_height: Column) -> Column:
    """A box from left, top, width and height in percent of a page, cut to whole pixels."""
    x, y, w, h = (b[k] / 100 for k in ("x", "y", "width", "height"))
    return box((x * page_width).cast("int"), (y * page_height).cast("int"), ((x + w) * page_width).cast("int"), ((y + h) * page_height).cast("int"))


def rescale(b: Column, old: tuple[Column, Column], new: tuple[Column, Column]) -> Column:
    """A box of one page size on another, cut to whole pixels."""
    sx, sy = new[0] / old[0], new[1] / old[1]
    return box(*(c.cast("int") for c in (b["xtl"] * sx, b["ytl"] * sy, b["xbr"] * sx, b["ybr"] * sy)))


def enlarge(b: Column, factor: Column, page: tuple[Column, Column]) -> Column:
    """A box scaled about its centre; what one side loses at the page's edge the other gains, within the page."""
    out = {}
    for lo, hi, size in (("xtl", "xbr", page[0]), ("ytl", "ybr", page[1])):
        mid, half = (b[lo] + b[hi]) / 2, (b[hi] - b[lo]) * factor / 2
        before, after = F.greatest(half - mid, F.lit(0.0)), F.greatest(mid + half - size, F.lit(0.0))
        out[lo] = F.greatest(mid - half - after, F.lit(0.0)).cast("int")
        out[hi] = F.least(mid + half + before, size.cast("double")).cast("int")
    return box(*(out[s] for s in SIDES))


def snap(b: Column, old: tuple[Column, Column], new: tuple[Column, Column], epsilon: float = 2.0) -> Column:
    """Edges within epsilon of the old page's border put on the new page's."""
    to = lambda v, a, z: F.when(v >= a - epsilon, z).when(v <= epsilon, 0.0).otherwise(v)
    return box(to(b["xtl"], old[0], new[0]), to(b["ytl"], old[1], new[1]), to(b["xbr"], old[0], new[0]), to(b["ybr"], old[1], new[1]))


def intersection(a: Column, b: Column) -> Column:
    """The part of a in b; inverted if they don't meet."""
    return box(F.greatest(a["xtl"], b["xtl"]), F.greatest(a["ytl"], b["ytl"]), F.least(a["xbr"], b["xbr"]), F.least(a["ybr"], b["ybr"]))


def contains(outer: Column, inner: Column) -> Column:
    return (outer["xtl"] <= inner["xtl"]) & (outer["ytl"] <= inner["ytl"]) & (outer["xbr"] >= inner["xbr"]) & (outer["ybr"] >= inner["ybr"])


def coverage(outer: Column, inner: Column) -> Column:
    """Share of the inner box that the outer covers; 0 for a box without area."""
    own = width(inner) * height(inner)
    return F.when(own > 0, area(intersection(outer, inner)) / own).otherwise(0.0)


def yolo(b: dict[str, Column]) -> dict[str, Column]:
    """Centre and size as parts of the page, from percent."""
    return {"xc": (b["x"] + b["width"] / 2) / 100, "yc": (b["y"] + b["height"] / 2) / 100, "w": b["width"] / 100, "h": b["height"] / 100}


def from_yolo(xc: Column, yc: Column, w: Column, h: Column) -> dict[str, Column]:
    return {"x": (xc - w / 2) * 100, "y": (yc - h / 2) * 100, "width": w * 100, "height": h * 100}


def xyxy(corners: Column, centred: Column) -> Column:
    """A box from its corners, else from centre and size; null and short lists count as absent."""
    c = [F.get(centred, F.lit(k)) for k in range(4)]
    other = box(c[0] - c[2] / 2, c[1] - c[3] / 2, c[0] + c[2] / 2, c[1] + c[3] / 2)
    return F.when(F.size(corners) >= 4, box(*(F.get(corners, F.lit(k)) for k in range(4)))).when(F.size(centred) >= 4, other)


def rotate(p: Column, pivot: Column, degrees: Column) -> Column:
    a = F.radians(degrees)
    dx, dy = p["x"] - pivot["x"], p["y"] - pivot["y"]
    return point(pivot["x"] + dx * F.cos(a) - dy * F.sin(a), pivot["y"] + dx * F.sin(a) + dy * F.cos(a))


def similarity(b: Column, reference: Column, scale: Column, shift_x: Column, shift_y: Column, degrees: Column, inverse: bool = False) -> Column:
    """Corners of a box that is shifted, scaled about its own centre and turned by -degrees about a reference point."""
    if inverse:
        scale, shift_x, shift_y, degrees = F.try_divide(F.lit(1.0), scale), -shift_x, -shift_y, -degrees
    cx, cy = (b["xtl"] + b["xbr"]) / 2 + shift_x, (b["ytl"] + b["ybr"]) / 2 + shift_y
    w, h = width(b) * scale / 2, height(b) * scale / 2
    corners = [point(cx + sx * w, cy + sy * h) for sx, sy in ((-1, -1), (1, -1), (1, 1), (-1, 1))]
    return F.array(*(rotate(p, reference, -degrees) for p in corners))


def homography(b: Column, m: Sequence[Column]) -> Column:
    """Corners of a box under a 3 x 3 matrix given by rows; null where a corner goes to infinity."""

    def move(x: Column, y: Column) -> Column:
        z = m[6] * x + m[7] * y + m[8]
        return point(F.try_divide(m[0] * x + m[1] * y + m[2], z), F.try_divide(m[3] * x + m[4] * y + m[5], z))

    return F.array(move(b["xtl"], b["ytl"]), move(b["xbr"], b["ytl"]), move(b["xbr"], b["ybr"]), move(b["xtl"], b["ybr"]))


def angle(a: Column, b: Column, c: Column) -> Column:
    """Degrees at b between a and c; null if two points are one."""
    dot = (a["x"] - b["x"]) * (c["x"] - b["x"]) + (a["y"] - b["y"]) * (c["y"] - b["y"])
    cosine = F.try_divide(dot, distance(a, b) * distance(c, b))
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))))


def shoelace(pts: Column) -> Column:
    p = [F.get(pts, F.lit(k)) for k in range(4)]
    twice = [p[k]["x"] * p[(k + 1) % 4]["y"] - p[(k + 1) % 4]["x"] * p[k]["y"] for k in range(4)]
    return F.abs(reduce(lambda a, b: a + b, twice)) / 2


def convex(pts: Column) -> Column:
    p = [F.get(pts, F.lit(k)) for k in range(4)]
    turn = []
    for k in range(4):
        a, b, c = p[k], p[(k + 1) % 4], p[(k + 2) % 4]
        turn.append((b["x"] - a["x"]) * (c["y"] - b["y"]) - (b["y"] - a["y"]) * (c["x"] - b["x"]))
    return F.array_min(F.array(*turn)) * F.array_max(F.array(*turn)) >= 0


def validity(pts: Column, w: Column, h: Column, tolerance: float = 10.0, factor: float = 1.0) -> Column:
    """What is wrong with a moved test square of width w and height h: convex, area (0.4 to 1.6 of its own), angle, or ok."""
    ratio = F.try_divide(shoelace(pts), w * h * factor)
    p = [F.get(pts, F.lit(k)) for k in range(4)]
    worst = F.array_max(F.array(*(F.abs(angle(p[k - 1], p[k], p[(k + 1) % 4]) - 90) for k in range(4))))
    return F.when(~convex(pts), "convex").when((ratio < 0.4) | (ratio > 1.6) | ratio.isNull(), "area").when((worst > tolerance) | worst.isNull(), "angle").otherwise("ok")


def alignment(pairs: Column) -> Column:
    """Scale, shift and rotation from an array of `struct<shift: point, center: point>`.

    The reference is the centre nearest the origin, its partner the one farthest from that; the shift is the first
    pair's. Fewer than two pairs, or a reference without a partner, give the identity.
    """
    zero = point(F.lit(0.0), F.lit(0.0))
    cs = F.transform(pairs, lambda p: p["center"])
    to_origin = F.transform(cs, lambda c: distance(c, zero))
    first = F.array_position(to_origin, F.array_min(to_origin)) - 1
    a = F.get(pairs, first)
    apart = F.transform(cs, lambda c: distance(c, a["center"]))
    b = F.get(pairs, F.array_position(apart, F.array_max(apart)) - 1)
    moved = lambda p: point(p["center"]["x"] + p["shift"]["x"], p["center"]["y"] + p["shift"]["y"])
    old = distance(a["center"], b["center"])
    slope = lambda p, q: F.when(q["y"] != p["y"], F.atan((q["x"] - p["x"]) / (q["y"] - p["y"]))).otherwise(F.signum(q["x"] - p["x"]) * F.pi() / 2)
    turned = F.degrees(slope(moved(a), moved(b)) - slope(a["center"], b["center"]))
    shift = F.get(pairs, F.lit(0))["shift"]
    made = F.struct(F.when(old > 0, distance(moved(a), moved(b)) / old).otherwise(1.0).alias("scale"), shift["x"].alias("shift_x"), shift["y"].alias("shift_y"), turned.alias("degrees"), a["center"].alias("reference"))
    none = F.struct(F.lit(1.0).alias("scale"), F.lit(0.0).alias("shift_x"), F.lit(0.0).alias("shift_y"), F.lit(0.0).alias("degrees"), zero.alias("reference"))
    return F.when((F.size(pairs) >= 2) & (old > 0), made).otherwise(none)


def stretch(b: Column, scale: Column, shift_x: Column, shift_y: Column) -> Column:
    """A box grown by a scale above 1 about its centre, then on the side that the shift points to; whole pixels."""
    out = {}
    for lo, hi, shift in (("xtl", "xbr", shift_x), ("ytl", "ybr", shift_y)):
        mid, half = (b[lo] + b[hi]) / 2, (b[hi] - b[lo]) / 2 * F.greatest(scale, F.lit(1.0))
        out[lo] = (mid - half + F.least(shift, F.lit(0.0))).cast("int")
        out[hi] = (mid + half + F.greatest(shift, F.lit(0.0))).cast("int")
    return box(*(out[s] for s in SIDES))
