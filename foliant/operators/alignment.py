"""How a page lies on its template: transformations from matched regions, boxes moved by them, and corrections of close boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g


def transformations(matches: DataFrame, keep: list[str], position: str = "position") -> DataFrame:
    """One row per page: `scale, shift_x, shift_y, degrees, reference_x, reference_y, n_matched`, from rows of regions with
    `found, shift_x, shift_y, center_x, center_y` in order of position. Pages with fewer than two found regions keep the identity; null
    coordinates count as not found."""
    good = F.col("found") & F.col("shift_x").isNotNull() & F.col("shift_y").isNotNull() & F.col("center_x").isNotNull() & F.col("center_y").isNotNull()
    pair = F.struct(F.col(position).alias("p"), g.point(F.col("shift_x"), F.col("shift_y")).alias("shift"), g.point(F.col("center_x"), F.col("center_y")).alias("center"))
    pages = matches.groupBy(*keep).agg(F.sort_array(F.collect_list(F.when(good, pair))).alias("pairs"))
    rows = pages.select(*keep, F.size("pairs").alias("n_matched"), g.alignment(F.col("pairs")).alias("t"))
    return rows.select(*keep, "t.scale", "t.shift_x", "t.shift_y", "t.degrees", F.col("t.reference.x").alias("reference_x"), F.col("t.reference.y").alias("reference_y"), "n_matched")


def extra_shifts(matches: DataFrame, keep: list[str], least: int) -> DataFrame:
    """One row per page: `aligned` (at least so many regions found again after the page was moved) and the greatest and least shifts
    that are left, 0 where none was found."""
    at = lambda f, c: F.coalesce(f(F.when(F.col("found"), F.col(c))), F.lit(0.0))
    return matches.groupBy(*keep).agg(
        (F.count_if(F.col("found")) >= least).alias("aligned"), at(F.max, "shift_x").alias("most_x"), at(F.min, "shift_x").alias("least_x"), at(F.max, "shift_y").alias("most_y"), at(F.min, "shift_y").alias("least_y")
    )


def moved(box: Column, t: str = "") -> Column:
    """Corners of a box under the transformation of columns that begin with a prefix."""
    c = lambda n: F.col(t + n)
    return g.similarity(box, g.point(c("reference_x"), c("reference_y")), c("scale"), c("shift_x"), c("shift_y"), c("degrees"))


def close_box(box: Column, scale: Column, shifts: list[tuple[Column, Column]]) -> Column:
    """A box that stays close to what it hides: grown by each shift in turn, each time also by a scale above 1; whole pixels."""
    for x, y in shifts:
        box = g.stretch(box, scale, x, y)
    return box


def close_quad(pts: Column, scale: Column, shift_x: Column, shift_y: Column) -> Column:
    """A turned box grown by a scale above 1 about its centre, then on the side of each shift along its own edges. Edges of no length
    have no direction and don't grow."""
    mid = g.point(*(F.aggregate(F.transform(pts, axis), F.lit(0.0), lambda a, v: a + v) / 4 for axis in (lambda p: p["x"], lambda p: p["y"])))
    more = F.greatest(scale, F.lit(1.0))
    p = [g.point(mid["x"] + (F.get(pts, F.lit(k))["x"] - mid["x"]) * more, mid["y"] + (F.get(pts, F.lit(k))["y"] - mid["y"]) * more) for k in range(4)]

    def along(a: Column, b: Column, by: Column) -> tuple[Column, Column]:
        size = g.distance(a, b)
        return tuple(F.coalesce(F.try_divide((b[k] - a[k]) * by, size), F.lit(0.0)) for k in "xy")

    right, left = along(p[0], p[1], F.greatest(shift_x, F.lit(0.0))), along(p[0], p[1], F.least(shift_x, F.lit(0.0)))
    down, up = along(p[0], p[3], F.greatest(shift_y, F.lit(0.0))), along(p[0], p[3], F.least(shift_y, F.lit(0.0)))
    sides = ((left, up), (right, up), (right, down), (left, down))
    return F.array(*(g.point(q["x"] + a[0] + b[0], q["y"] + a[1] + b[1]) for q, (a, b) in zip(p, sides, strict=True)))


def page_votes(regions: DataFrame, keep: list[str], least: int = 3) -> DataFrame:
    """`n_regions, n_votes, accepted` of each page from regions with `decision`; a null decision is no vote."""
    votes = F.count_if(F.col("decision"))
    return regions.groupBy(*keep).agg(F.count("*").alias("n_regions"), votes.alias("n_votes"), (votes >= least).alias("accepted"))
