"""Boxes of a page held against each other. Every join has the page as its equi key; geometry is a residual condition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g


def smallest_containing(inner: DataFrame, outer: DataFrame, page: list[str]) -> DataFrame:
    """`page, inner_no, outer_no`: the smallest box that contains the inner one, the first of ties; null if none does.

    Both frames have the page, `no` and `box`. The outer side is reduced as the join goes: one least struct per inner box.
    """
    a = inner.select(*page, F.col("no").alias("inner_no"), F.col("box").alias("_i"))
    b = outer.select(*page, F.col("no").alias("_o_no"), F.col("box").alias("_o"))
    hits = a.join(b, page).where(g.contains(F.col("_o"), F.col("_i")))
    best = hits.groupBy(*page, "inner_no").agg(F.min(F.struct(g.area(F.col("_o")).alias("a"), F.col("_o_no").alias("n"))).alias("_b"))
    return a.select(*page, "inner_no").join(best, [*page, "inner_no"], "left").select(*page, "inner_no", F.col("_b.n").alias("outer_no"))


def covering(inner: DataFrame, outer: DataFrame, page: list[str], least: float = 0.5) -> DataFrame:
    """`page, inner_no, outer_no, covered` of pairs whose outer box covers that share of the inner at least."""
    a = inner.select(*page, F.col("no").alias("inner_no"), F.col("box").alias("_i"))
    b = outer.select(*page, F.col("no").alias("outer_no"), F.col("box").alias("_o"))
    return a.join(b, page).withColumn("covered", g.coverage(F.col("_o"), F.col("_i"))).where(F.col("covered") >= least).select(*page, "inner_no", "outer_no", "covered")


def censor_boxes(close: DataFrame, censor: DataFrame, page: list[str]) -> DataFrame:
    """What to blacken: each close box cut to the censor boxes that cover half of it, where these are partial, else whole.

    `censor` has a flag `partial`, and with repeated pairs each counts.
    """
    pairs = covering(close, censor, page)
    a = close.select(*page, F.col("no").alias("inner_no"), F.col("box").alias("_i"))
    b = censor.select(*page, F.col("no").alias("outer_no"), F.col("box").alias("_o"), "partial")
    both = pairs.join(a, [*page, "inner_no"]).join(b, [*page, "outer_no"])
    return both.select(*page, "inner_no", "outer_no", "partial", F.when(F.col("partial"), g.intersection(F.col("_i"), F.col("_o"))).otherwise(F.col("_i")).alias("box"))


def file_rows(boxes: DataFrame, path: str, page: str) -> DataFrame:
    """Rows of the file that lists partial boxes: `filename, xtl, ytl, xbr, ybr`."""
    return boxes.where("partial").select(F.concat(F.lit(path), F.lit("page_"), F.col(page).cast("string"), F.lit(".png")).alias("filename"), "box.*")


def in_order(boxes: DataFrame, page: list[str], blank: str) -> DataFrame:
    """Boxes with their number on the page, blank ones last."""
    return boxes.withColumn("n", F.row_number().over(Window.partitionBy(*page).orderBy(F.coalesce(F.col(blank), F.lit(False)), "no")) - 1)


def visible(detections: DataFrame, classes: list[str] | None = None, least: float = 0.0) -> DataFrame:
    """Detections of some classes with some confidence; the breaks of a text are put at its box's left edge where they are
    no wider than the box, and those outside the box are left out."""
    rows = detections.where(F.col("confidence") >= least)
    if classes is not None:
        rows = rows.where(F.col("class_name").isin(classes))
    b = F.col("box")
    at = F.transform("text_breaks", lambda x: F.when(x > g.width(b), x).otherwise(x + b["xtl"]))
    return rows.withColumn("text_breaks", F.filter(at, lambda x: (x >= b["xtl"]) & (x <= b["xbr"])))
