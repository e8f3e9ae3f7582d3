"""Annotation files: pages with typed boxes, from JSON and XML, and label files made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The parts of an annotation page that are read. Attributes that are lists or single values are read as texts.
PAGES = """array<struct<image:string, image_type:string, roi_type:string, censor_type:string, close_type:string,
label:array<struct<x:double, y:double, width:double, height:double, rotation:double, rectanglelabels:string, original_width:int, original_height:int>>>>"""
#: Labels whose boxes take their sub-attribute from a list of the page.
SUBTYPES = {"roi": "roi_type", "censor": "censor_type", "censor-close": "close_type", "censor_close": "close_type"}
TASKS = """array<struct<data:struct<image:string>, annotations:array<struct<result:array<struct<type:string,
value:struct<x:string, y:string, width:string, height:string, rectanglelabels:array<string>>>>>>>>"""
IMAGE = """_id string, _name string, _width int, _height int, box array<struct<_label:string, _source:string, _occluded:string,
_xtl:double, _ytl:double, _xbr:double, _ybr:double, _z_order:int, attribute:array<struct<_name:string, _VALUE:string>>>>"""


def page_number(image: Column) -> Column:
    return F.nullif(F.regexp_extract(image, r"page_([0-9]+)\.png$", 1), F.lit("")).cast("int")


def as_list(text: Column) -> Column:
    """A JSON list of texts, or a single text as a list of one; empty for null."""
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.coalesce(F.from_json(text, "array<string>"), F.array(text)))


def pages(df: DataFrame, body: str, keep: list[str]) -> DataFrame:
    """One row per page of an annotation file; of entries with one page number the first. `image_type` is '' if absent.

    A body may be one page. Bodies that can't be read, and pages without a number, give no rows.
    """
    wrapped = F.when(F.ltrim(F.col(body)).startswith("["), F.col(body)).otherwise(F.concat(F.lit("["), F.col(body), F.lit("]")))
    rows = df.select(*keep, F.posexplode(F.from_json(wrapped, PAGES)).alias("page_pos", "p"))
    rows = rows.withColumn("page", page_number(F.col("p.image"))).where("page IS NOT NULL")
    first = rows.groupBy(*keep, "page").agg(F.min_by("p", "page_pos").alias("p"), F.min("page_pos").alias("page_pos"))
    size = F.get(F.col("p.label"), F.lit(0))
    return first.select(*keep, "page", "page_pos", F.col("p.image").alias("image"), F.coalesce(F.col("p.image_type"), F.lit("")).alias("image_type"), size["original_width"].alias("page_width"), size["original_height"].alias("page_height"), *(as_list(F.col(f"p.{c}")).alias(c) for c in dict.fromkeys(SUBTYPES.values())), F.col("p.label").alias("label"))


def regions(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per box of pages: its geometry, first label, and the sub-attribute that stands at its place among the page's boxes
    of that label; null where the list is shorter."""
    rows = df.select(*keep, "page", *dict.fromkeys(SUBTYPES.values()), F.posexplode("label").alias("box_no", "b"))
    rows = rows.withColumn("label", F.get(as_list(F.col("b.rectanglelabels")), F.lit(0)))
    nth = F.row_number().over(Window.partitionBy(*keep, "page", "label").orderBy("box_no")) - 1
    rows = rows.withColumn("_n", nth)
    sub = F.coalesce(*(F.when(F.col("label") == k, F.get(F.col(c), F.col("_n"))) for k, c in SUBTYPES.items()))
    return rows.select(*keep, "page", "box_no", "label", sub.alias("sub_attribute"), *(F.col(f"b.{c}").alias(c) for c in ("x", "y", "width", "height")))


def label_rows(df: DataFrame, body: str, order: str, classes: dict[str, int], separator: str = "%5C") -> DataFrame:
    """Label files of a labelling tool's tasks: `file_name, box_no, line`, a line per box, with nulls for tasks without any.

    A file is named by the last two parts of the image's path; those named before take _1, _2 and so on in their order.
    Unknown classes are 0. Numbers may be written as texts, with a comma or a percent sign; a box without all four has no line. A hot name is numbered by one task, which sorts its keys only.
    """
    wrapped = F.when(F.ltrim(F.col(body)).startswith("["), F.col(body)).otherwise(F.concat(F.lit("["), F.col(body), F.lit("]")))
    tasks = df.select(F.col(order).alias("_o"), F.posexplode(F.from_json(wrapped, TASKS)).alias("_t", "t")).where(F.col("t.data.image").isNotNull())
    parts = F.split(F.col("t.data.image"), separator)
    name = F.regexp_replace(F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), "_"), r"\.[^.]*$", "")
    named = tasks.withColumn("_name", name)
    nth = F.row_number().over(Window.partitionBy("_name").orderBy("_o", "_t")) - 1
    named = named.withColumn("file_name", F.when(nth == 0, F.col("_name")).otherwise(F.concat("_name", F.lit("_"), nth.cast("string"))))
    results = F.filter(F.flatten(F.transform("t.annotations", lambda a: a["result"])), lambda r: r["type"] == "rectanglelabels")
    rows = named.select("file_name", F.posexplode_outer(results).alias("box_no", "r"))
    ids = F.create_map(*(x for k, v in classes.items() for x in (F.lit(k), F.lit(v)))) if classes else F.create_map().cast("map<string,int>")
    v = F.col("r.value")
    x, y, w, h = (F.regexp_replace(F.replace(F.rtrim(F.trim(v[c]), F.lit("%")), F.lit(","), F.lit(".")), " ", "").try_cast("double") for c in ("x", "y", "width", "height"))
    cls = F.coalesce(F.try_element_at(ids, F.coalesce(F.get(v["rectanglelabels"], F.lit(0)), F.lit(""))), F.lit(0))
    line = F.format_string("%d %.6f %.6f %.6f %.6f", cls, (x + w / 2) / 100, (y + h / 2) / 100, w / 100, h / 100)
    return rows.select("file_name", "box_no", F.when((x + y + w + h).isNotNull(), line).alias("line"))


def to_predictions(tasks: DataFrame, version: str, score: float = 0.95) -> DataFrame:
    """Tasks with their annotations as predictions; those without annotations stay as they are."""
    made = F.transform("annotations", lambda a: F.struct(a["result"].alias("result"), F.lit(score).alias("score"), F.lit(version).alias("model_version")))
    have = F.size("annotations") > 0
    return tasks.withColumn("predictions", F.when(have, made)).withColumn("annotations", F.when(have, F.slice("annotations", 1, 0)).otherwise(F.col("annotations")))


def xml_boxes(images: DataFrame) -> DataFrame:
    """One row per box of XML images read with IMAGE: coordinates 0 if absent, attributes without a text left out."""
    rows = images.select(F.col("_id").alias("image_id"), F.col("_name").alias("image_name"), F.col("_width").alias("page_width"), F.col("_height").alias("page_height"), F.posexplode("box").alias("box_no", "b"))
    sides = [F.coalesce(F.col(f"b._{s}"), F.lit(0.0)).alias(s) for s in ("xtl", "ytl", "xbr", "ybr")]
    kept = F.filter(F.coalesce(F.col("b.attribute"), F.array()), lambda a: a["_VALUE"].isNotNull() & a["_name"].isNotNull())
    attributes = F.map_from_entries(F.transform(kept, lambda a: F.struct(a["_name"], a["_VALUE"])))
    return rows.select("image_id", "image_name", "page_width", "page_height", "box_no", F.col("b._label").alias("label"), *sides, attributes.alias("attributes"))


def select_boxes(boxes: DataFrame, image_id: str | None = None, image_name: str | None = None, labels: list[str] | None = None) -> DataFrame:
    for column, value in (("image_id", image_id), ("image_name", image_name)):
        boxes = boxes if value is None else boxes.where(F.col(column) == value)
    return boxes if labels is None else boxes.where(F.col("label").isin(labels))


def set_attribute(boxes: DataFrame, name: str, value: str, chosen: Column, overwrite: bool = True) -> DataFrame:
    """Chosen boxes with an attribute set; without `overwrite` only where they lack it."""
    rest = F.map_filter("attributes", lambda k, v: k != name)
    applies = chosen if overwrite else chosen & ~F.map_contains_key("attributes", name)
    return boxes.withColumn("attributes", F.when(applies, F.map_concat(rest, F.create_map(F.lit(name), F.lit(value)))).otherwise(F.col("attributes")))


def image_summaries(boxes: DataFrame) -> DataFrame:
    """Per image: boxes by label, and the values of the attribute `blank` of its regions of interest."""
    counts = boxes.groupBy("image_id", "label").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.when(F.col("label") == "roi", F.try_element_at("attributes", F.lit("blank"))))).alias("b"))
    return counts.groupBy("image_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "n")))).alias("labels"), F.flatten(F.collect_list("b")).alias("blanks"))


def detections(df: DataFrame, body: str, keep: list[str]) -> DataFrame:
    """One row per detection of a page, from a list of pages or one page; null lists give none."""
    from ..functions.geometry import xyxy

    kind = "array<struct<page_number:int, detections:array<struct<class_name:string, class_id:int, confidence:double, bbox_xyxy:array<double>, bbox_xywh:array<double>, is_partial:boolean, text_breaks:array<double>>>>>"
    wrapped = F.when(F.ltrim(F.col(body)).startswith("["), F.col(body)).otherwise(F.concat(F.lit("["), F.col(body), F.lit("]")))
    per_page = df.select(*keep, F.explode(F.from_json(wrapped, kind)).alias("p"))
    rows = per_page.select(*keep, F.col("p.page_number").alias("page"), F.posexplode("p.detections").alias("detection_no", "d"))
    return rows.select(*keep, "page", "detection_no", "d.class_name", "d.class_id", "d.confidence", xyxy(F.col("d.bbox_xyxy"), F.col("d.bbox_xywh")).alias("box"), "d.is_partial", "d.text_breaks")
