"""Images, annotation files, tokens, alignment and archive members over the test tables, which stand in for scans.

`embeddings` gives grey images of 8 by 8, `lineitem` a page per order with a box, token, detection or member per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import text
from ..operators import alignment, annotations, boxes, images, selection, tokens
from ..sources import files
from ..streaming import ledger
from ..session import table

ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def _images(spark, d) -> DataFrame:
    """Grey levels 128 + 40 times a vector's values, rounded and kept in range."""
    level = F.transform("embedding", lambda x: F.least(F.greatest(F.floor(x.cast("double") * 40 + 128.5), F.lit(0)), F.lit(255)).cast("int"))
    data = F.unhex(F.array_join(F.transform(level, lambda v: F.lpad(F.hex(v), 2, "0")), ""))
    return table(spark, d, "embeddings").select("vec_id", F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("n_channels"), data.alias("data"))


def _pairs(spark, d) -> DataFrame:
    rows = _images(spark, d)
    other = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("data").alias("t_data"))
    return rows.join(other, "vec_id").withColumns({"t_height": F.lit(8), "t_width": F.lit(8)})


def image_measures(spark, d):
    """Black pixels, black and white, sums, means, crops and masks of each image."""
    return images.measures(_images(spark, d), ["vec_id"], (1, 2, 5, 6), 4, 0.25, black=100)


def image_comparison(spark, d):
    """Each image with the next as its template: correlation of levels and of sums, and whether as much is black."""
    out = images.compared(_pairs(spark, d), ["vec_id"])
    return out.select("vec_id", *((F.round(c, 4) + F.lit(0.0)).alias(c) for c in ("ncc", "row_ncc", "column_ncc")), "black_near")


def region_votes(spark, d):
    """Pages of ten regions, each held against the same image turned brighter or against the next one, and their votes."""
    rows = _pairs(spark, d).withColumn("t_data", F.when(F.col("vec_id") % 3 == 0, F.col("data")).otherwise(F.col("t_data")))
    return alignment.page_votes(images.compared(rows, ["vec_id"]).withColumn("page", F.floor(F.col("vec_id") / 10)), ["page"])


def template_location(spark, d):
    """Where a part of each image, three by three from the third column and second row, lies in the image itself."""
    rows = _images(spark, d)
    part = F.concat(*(F.substring("data", 8 * r + 3, 3) for r in (1, 2, 3)))
    got = images.located(rows.withColumns({"t_height": F.lit(3), "t_width": F.lit(3), "t_data": part}), ["vec_id"])
    return got.select("vec_id", "found", "x", "y", F.round("score", 4).alias("score"))


def image_censoring(spark, d):
    """Images with a rectangle in black, as hexadecimal."""
    corners = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((1, 2), (4, 2), (4, 5), (1, 5))))
    return images.censor(_images(spark, d).withColumn("quads", F.array(corners)), ["vec_id"]).select("vec_id", F.hex("censored").alias("levels"))


def _xml(spark, d) -> DataFrame:
    """An annotation file per order, as text, and its boxes."""
    line = F.format_string('<box label="%s" xtl="%s" ytl="%s" xbr="%s" ybr="%s" z_order="0"><attribute name="blank">%s</attribute><attribute name="none"/></box>', F.when(F.col("l_returnflag") == "R", "roi").otherwise("censor"), *(c.cast("string") for c in _sides()), F.col("l_linestatus"))
    page = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*ORDER, line.alias("x")))), lambda s: s["x"]), "").alias("boxes"))
    body = F.concat(F.lit('<image id="'), F.col("l_orderkey").cast("string"), F.lit('" name="page_'), F.col("l_orderkey").cast("string"), F.lit('.png" width="600" height="800">'), F.col("boxes"), F.lit("</image>"))
    return annotations.xml_boxes(page.select(F.from_xml(body, annotations.IMAGE).alias("i")).select("i.*"))


def _sides():
    x, y = F.col("l_partkey") % 500, F.col("l_suppkey") % 50 * 10
    return [c.cast("double") for c in (x, y, x + 40, y + F.col("l_quantity"))]


def xml_boxes(spark, d):
    """Boxes read from annotation files, with an attribute set on those of regions."""
    rows = annotations.set_attribute(_xml(spark, d), "seen", "yes", F.col("label") == "roi")
    return rows.select("image_name", "box_no", "label", "xtl", "ytl", "xbr", "ybr", F.try_element_at("attributes", F.lit("blank")).alias("blank"), F.try_element_at("attributes", F.lit("seen")).alias("seen"), F.size("attributes").alias("n_attributes"))


def xml_summaries(spark, d):
    rows = annotations.image_summaries(_xml(spark, d))
    return rows.select("image_id", *(F.coalesce(F.try_element_at("labels", F.lit(x)), F.lit(0).cast("long")).alias(f"n_{x}") for x in ("roi", "censor")), F.array_join("blanks", ",").alias("blanks"))


def xml_selection(spark, d):
    """Regions of one page by its name."""
    return annotations.select_boxes(_xml(spark, d), image_name="page_1.png", labels=["roi"]).select("image_id", "box_no", "xtl")


def detections(spark, d):
    """Detections read from JSON, by corners or else by centre and size, with the breaks of texts in their boxes."""
    x0, y0, x1, y1 = _sides()
    entry = F.struct(
        F.when(F.col("l_returnflag") == "R", "word").otherwise("mark").alias("class_name"), F.col("l_linenumber").alias("class_id"), (F.col("l_tax") * 10).alias("confidence"),
        F.when(F.col("l_linestatus") == "O", F.array(x0, y0, x1, y1)).alias("bbox_xyxy"), F.array((x0 + x1) / 2, (y0 + y1) / 2, x1 - x0, y1 - y0).alias("bbox_xywh"),
        (F.col("l_discount") > 0.05).alias("is_partial"), F.array(F.lit(5.0), F.col("l_quantity") * 10).alias("text_breaks"),
    )
    lines = table(spark, d, "lineitem").select("l_orderkey", F.struct(*ORDER, entry.alias("e")).alias("s"))
    page = lines.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list("s")), lambda s: s["e"]).alias("detections"))
    body = page.select("l_orderkey", F.to_json(F.struct(F.lit(3).alias("page_number"), "detections")).alias("body"))
    rows = boxes.visible(annotations.detections(body, "body", ["l_orderkey"]), ["word"], 0.1)
    return rows.select("l_orderkey", "page", "detection_no", "confidence", F.round("box.xtl", 6).alias("xtl"), F.round("box.ybr", 6).alias("ybr"), "is_partial", F.array_join(F.transform("text_breaks", lambda v: F.round(v, 3).cast("decimal(12,3)").cast("string")), ",").alias("breaks"))


def _tokens(spark, d) -> DataFrame:
    value = F.when(F.col("l_linenumber") % 3 == 0, F.lpad((F.col("l_partkey") * 37 % 1_000_000).cast("string"), 6, "0")).when(F.col("l_linenumber") % 3 == 1, (F.col("l_suppkey") % 10).cast("string"))
    value = F.coalesce(value, F.when(F.col("l_returnflag") == "R", F.lit("1234567")).otherwise(F.concat(F.lit("7"), F.lpad((F.col("l_partkey") % 1_000_000).cast("string"), 6, "0"))))
    rows = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*(F.min(c).alias(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_returnflag")))
    return rows.select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("pos"), value.alias("text"), (F.col("l_quantity") * 2).alias("conf"), (F.col("l_partkey") % 300).cast("int").alias("left"), (F.col("l_suppkey") % 40).cast("int").alias("top"), F.lit(60).alias("width"), F.lit(20).alias("height"))


def special_ids(spark, d):
    return tokens.special_ids(_tokens(spark, d))


def numeric_tokens(spark, d):
    return tokens.numeric(_tokens(spark, d)).select("page", "pos", "text", "right", "bottom")


def box_corners(spark, d):
    """Corners of boxes, put in order, as upright boxes again, grown by a shift, and the distance to the next page's corner."""
    x0, y0, x1, y1 = _sides()
    b = g.box(x0, y0, x1, y1)
    pts = g.polygon(b)
    mixed = F.array(*(F.get(pts, F.lit(k)) for k in (2, 0, 3, 1)))
    grown = alignment.close_box(b, F.lit(1.5), [(F.lit(7.0), F.lit(-4.0)), (F.lit(-3.0), F.lit(2.0))])
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", g.ordered_quad(mixed).alias("q"), g.bounds(mixed).alias("u"), grown.alias("c"), F.round(g.distance(g.center(b), g.point(F.lit(0), F.lit(0))), 6).alias("away"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *(F.get("q", F.lit(k))[a].alias(f"{a}{k}") for k in range(4) for a in "xy"), *(F.col(f"u.{s}").alias(f"upright_{s}") for s in g.SIDES), *(F.col(f"c.{s}").alias(f"close_{s}") for s in g.SIDES), "away")


def close_quads(spark, d):
    """Turned boxes grown by a scale and by shifts along their own edges."""
    x0, y0, x1, y1 = _sides()
    pts = F.array(g.point(x0, y0), g.point(x0 + 40, y0 + 30), g.point(x0 + 10, y0 + 70), g.point(x0 - 30, y0 + 40))
    got = alignment.close_quad(pts, F.lit(1.2), F.col("l_linenumber") - 4.0, F.col("l_quantity") - 25.0)
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", got.alias("q"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *((F.round(F.get("q", F.lit(k))[a], 6) + F.lit(0.0)).alias(f"{a}{k}") for k in range(4) for a in "xy"))


def _matches(spark, d) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*(F.min(c).alias(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_returnflag")))
    return rows.select("l_orderkey", F.col("l_linenumber").alias("position"), (F.col("l_returnflag") != "R").alias("found"), (F.col("l_quantity") - 25).alias("shift_x"), (F.col("l_suppkey") % 9 - 4.0).alias("shift_y"), (F.col("l_partkey") % 977 + 0.5).alias("center_x"), (F.col("l_partkey") % 1009 + 0.25).alias("center_y"))


def page_transformations(spark, d):
    """How each order's regions say that its page lies: scale, shift and turn from the regions nearest to and farthest from the corner."""
    rows = alignment.transformations(_matches(spark, d), ["l_orderkey"])
    return rows.select("l_orderkey", *((F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("scale", "shift_x", "shift_y", "degrees", "reference_x", "reference_y")), "n_matched")


def page_extra_shifts(spark, d):
    return alignment.extra_shifts(_matches(spark, d), ["l_orderkey"], 2)


def _members(spark, d) -> DataFrame:
    name = F.concat(F.when(F.col("l_returnflag") == "R", ".\\").otherwise("./"), F.lit("Q"), F.col("l_linenumber").cast("string"), F.lit("/"), F.when(F.col("l_linestatus") == "O", F.concat(F.lit("page_"), F.col("l_quantity").cast("int").cast("string"))).otherwise("hand"), F.lit(".PNG"))
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("archive"), files.member_key(name).alias("member"), F.col("l_quantity").alias("n_bytes")).groupBy("archive", "member").agg(F.min("n_bytes").alias("n_bytes"))


def archive_pages(spark, d):
    return files.page_members(_members(spark, d))


def archive_waves(spark, d):
    return files.waves_in(_members(spark, d)).select("archive", F.array_join(F.transform("qs", lambda q: q.cast("string")), ",").alias("qs"))


def archive_modalities(spark, d):
    return files.modalities(_members(spark, d), ["hand", "page_1"])


def archive_member(spark, d):
    """The member of a name, or one that ends in it."""
    return files.find_members(_members(spark, d), "./hand.png")


def scan_names(spark, d):
    """Base names, stems and page numbers of the exports' pages, and which are done."""
    rows = table(spark, d, "page_file").select(F.concat("file_path", F.lit("_"), (F.col("file_id") % 37).cast("string"), F.lit(".png")).alias("path"))
    named = files.with_page_number(rows).select("path", "page", files.base_name(F.col("path")).alias("name"), files.stem(F.col("path")).alias("stem"))
    return named.withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]*$", 1))


def scan_folders(spark, d):
    return files.folders(table(spark, d, "page_file").select(F.col("file_path").alias("path")))


def subject_row(spark, d):
    """The first row of the least subject."""
    rows = table(spark, d, "training").groupBy("unique_id").agg(F.max("last_avail_q").alias("last_avail_q"))
    least = rows.agg(F.min(selection.subject_of(F.col("unique_id")))).first()[0]
    return selection.find_subject(rows, least or "")


def subject_descriptions(spark, d):
    """What describes a subject, and the day of birth as text."""
    rows = table(spark, d, "training").select("row_id", "unique_id", "split", "q_5_num_x", "case_dt_dateq1", "relative_age", "birth_date")
    made = selection.description(rows.drop("row_id"))
    return made.select("unique_id", F.size("description").alias("n_facts"), *(F.col("description")[c].alias(c) for c in ("split", "relative_age")), selection.date_text(F.col("description")["birth_date"]).alias("born")).distinct()


def wave_windows(spark, d):
    """Successful runs per wave and day, as the streaming count gives them over a table."""
    return ledger.windowed_counts(table(spark, d, "combined_success_ids").where("logged_at IS NOT NULL"))


def text_normal_form(spark, d):
    """Names in lower case without signs, blanks made one."""
    return table(spark, d, "part").select("p_partkey", text.normalize(F.concat("p_name", F.lit("  & "), F.upper("p_type"), F.lit(" (#1)\t!"))).alias("normal"))


QUERIES = {
    f.__name__: f
    for f in (
        image_measures, image_comparison, region_votes, template_location, image_censoring, xml_boxes, xml_summaries, xml_selection, detections, special_ids, numeric_tokens, box_corners,
        close_quads, page_transformations, page_extra_shifts, archive_pages, archive_waves, archive_modalities, archive_member, scan_names, scan_folders, subject_row, subject_descriptions,
        wave_windows, text_normal_form,
    )
}

_IMG = "(SELECT vec_id, list_transform(embedding, lambda x: least(greatest(floor(x::DOUBLE * 40 + 128.5), 0), 255)::INT) AS p FROM embeddings)"
_PX = f"(SELECT vec_id, i // 8 AS r, i % 8 AS c, p[i + 1] AS v FROM {_IMG}, range(64) t(i))"
_JOIN = "array_to_string({}, ',')"


def _part(rows: range, columns: range, inside: str = "") -> str:
    cells = [f"p[{8 * r + c + 1}]" for r in rows for c in columns]
    return _JOIN.format(f"[{', '.join(cells)}]")


_SMALL = _JOIN.format("[" + ", ".join(f"round_even((p[{16 * r + 2 * c + 1}] + p[{16 * r + 2 * c + 2}] + p[{16 * r + 2 * c + 9}] + p[{16 * r + 2 * c + 10}]) * 250.0, 0)::INT" for r in range(4) for c in range(4)) + "]")
_S = "(l_partkey % 500)::DOUBLE AS x0, (l_suppkey % 50 * 10)::DOUBLE AS y0, (l_partkey % 500 + 40)::DOUBLE AS x1, (l_suppkey % 50 * 10) + l_quantity AS y1"
_LINES = f"(SELECT *, {_S}, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(ORDER)}) - 1 AS n FROM lineitem)"
_ONE = "(SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey, min(l_quantity) AS l_quantity, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1, 2)"
_TOK = f"""(SELECT l_orderkey AS page, l_linenumber AS pos, CASE WHEN l_linenumber % 3 = 0 THEN lpad((l_partkey * 37 % 1000000)::VARCHAR, 6, '0') WHEN l_linenumber % 3 = 1 THEN (l_suppkey % 10)::VARCHAR
  WHEN l_returnflag = 'R' THEN '1234567' ELSE '7' || lpad((l_partkey % 1000000)::VARCHAR, 6, '0') END AS text, (l_quantity * 2)::INT AS conf, (l_partkey % 300)::INT AS "left", (l_suppkey % 40)::INT AS top FROM {_ONE})"""
_MATCH = f"(SELECT l_orderkey, l_linenumber AS position, l_returnflag <> 'R' AS found, (l_quantity - 25)::DOUBLE AS sx, (l_suppkey % 9 - 4)::DOUBLE AS sy, (l_partkey % 977 + 0.5)::DOUBLE AS cx, (l_partkey % 1009 + 0.25)::DOUBLE AS cy FROM {_ONE})"
_MEM = "(SELECT l_orderkey AS archive, lower('q' || l_linenumber || '/' || CASE WHEN l_linestatus = 'O' THEN 'page_' || l_quantity::INT ELSE 'hand' END || '.png') AS member, min(l_quantity) AS n_bytes FROM lineitem GROUP BY 1, 2)"
_SLOPE = "CASE WHEN {b}y <> {a}y THEN atan(({b}x - {a}x) / ({b}y - {a}y)) ELSE sign({b}x - {a}x) * pi() / 2 END"
_GROW = "x0 + x1 AS sx, y0 + y1 AS sy, x1 - x0 AS w, y1 - y0 AS h"


def _grown(lo: str, hi: str, shift: int) -> tuple[str, str]:
    mid, half = f"(({lo} + {hi}) / 2)", f"(({hi} - {lo}) / 2 * 1.5)"
    return f"trunc({mid} - {half} + {min(shift, 0)})", f"trunc({mid} + {half} + {max(shift, 0)})"


(_GX0, _GX1), (_GY0, _GY1) = _grown("x0", "x1", 7), _grown("y0", "y1", -4)
(_HX0, _HX1), (_HY0, _HY1) = _grown("gx0", "gx1", -3), _grown("gy0", "gy1", 2)


def _quad_point(k: int) -> str:
    """A corner of the turned square of edges (40, 30) and (-30, 40), grown by 1.2 about its middle (5, 35), and moved along its edges."""
    x, y = ((0, 0), (40, 30), (10, 70), (-30, 40))[k]
    a = "greatest(l_linenumber - 4.0, 0)" if k in (1, 2) else "least(l_linenumber - 4.0, 0)"
    b = "greatest(l_quantity - 25.0, 0)" if k in (2, 3) else "least(l_quantity - 25.0, 0)"
    return f"round(x0 + 5 + {x - 5} * 1.2 + 0.8 * {a} - 0.6 * {b}, 6) + 0.0 AS x{k}, round(y0 + 35 + {y - 35} * 1.2 + 0.6 * {a} + 0.8 * {b}, 6) + 0.0 AS y{k}"


SQL = {
    "image_measures": f"""SELECT vec_id, len(list_filter(p, lambda v: v < 100)) AS n_black, {_JOIN.format('list_transform(p, lambda v: CASE WHEN v > 128 THEN 255 ELSE 0 END)')} AS binary,
  {_JOIN.format('[' + ', '.join(f'list_sum(p[{8 * r + 1}:{8 * r + 8}])::BIGINT' for r in range(8)) + ']')} AS row_sums, {_JOIN.format('[' + ', '.join(' + '.join(f'p[{8 * r + c + 1}]' for r in range(8)) for c in range(8)) + ']')} AS column_sums,
  {_SMALL} AS small, {_part(range(2, 6), range(1, 5))} AS patch, {_part(range(2, 6), range(2, 6))} AS inner, {_part(range(2, 6), range(1, 5))} AS masked FROM {_IMG}""",
    "image_comparison": f"""WITH x AS (SELECT a.vec_id, a.r, a.c, a.v AS v, b.v AS w FROM {_PX} a JOIN {_PX} b ON b.vec_id = a.vec_id + 1 AND b.r = a.r AND b.c = a.c),
r AS (SELECT vec_id, corr(v, w) AS n FROM (SELECT vec_id, r, sum(v) AS v, sum(w) AS w FROM x GROUP BY 1, 2) GROUP BY 1), c AS (SELECT vec_id, corr(v, w) AS n FROM (SELECT vec_id, c, sum(v) AS v, sum(w) AS w FROM x GROUP BY 1, 2) GROUP BY 1)
SELECT x.vec_id, round(corr(v, w), 4) + 0.0 AS ncc, round(any_value(r.n), 4) + 0.0 AS row_ncc, round(any_value(c.n), 4) + 0.0 AS column_ncc, abs(count(*) FILTER (WHERE v < 100) - count(*) FILTER (WHERE w < 100)) <= 0.1 * greatest(count(*) FILTER (WHERE w < 100), 1) AS black_near
FROM x JOIN r USING (vec_id) JOIN c USING (vec_id) GROUP BY 1""",
    "template_location": f"SELECT vec_id, true AS found, 2::BIGINT AS x, 1::BIGINT AS y, 1.0::DOUBLE AS score FROM {_IMG}",
    "image_censoring": f"SELECT vec_id, {'||'.join('chr(48)||chr(48)' if 1 <= c <= 4 and 2 <= r <= 5 else f'lpad(upper(hex(p[{8 * r + c + 1}]::BIGINT)), 2, chr(48))' for r in range(8) for c in range(8))} AS levels FROM {_IMG}",
    "xml_boxes": f"SELECT 'page_' || l_orderkey || '.png' AS image_name, n::INT AS box_no, CASE WHEN l_returnflag = 'R' THEN 'roi' ELSE 'censor' END AS label, x0 AS xtl, y0 AS ytl, x1 AS xbr, y1 AS ybr, l_linestatus AS blank, CASE WHEN l_returnflag = 'R' THEN 'yes' END AS seen, CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS n_attributes FROM {_LINES}",
    "xml_summaries": "SELECT l_orderkey::VARCHAR AS image_id, count(*) FILTER (WHERE l_returnflag = 'R') AS n_roi, count(*) FILTER (WHERE l_returnflag <> 'R') AS n_censor, coalesce(string_agg(l_linestatus, ',' ORDER BY l_linestatus) FILTER (WHERE l_returnflag = 'R'), '') AS blanks FROM lineitem GROUP BY 1",
    "xml_selection": f"SELECT l_orderkey::VARCHAR AS image_id, n::INT AS box_no, x0 AS xtl FROM {_LINES} WHERE l_orderkey = 1 AND l_returnflag = 'R'",
    "detections": f"""SELECT l_orderkey, 3 AS page, n::INT AS detection_no, l_tax * 10 AS confidence, round(x0, 6) AS xtl, round(y1, 6) AS ybr, l_discount > 0.05 AS is_partial,
  array_to_string(list_transform(list_filter(list_transform([5.0, l_quantity * 10], lambda v: CASE WHEN v > 40 THEN v ELSE v + x0 END), lambda v: v >= x0 AND v <= x1), lambda v: v::DECIMAL(12,3)::VARCHAR), ',') AS breaks
FROM {_LINES} WHERE l_returnflag = 'R' AND l_tax * 10 >= 0.1""",
    "numeric_tokens": f"SELECT page, pos, text, \"left\" + 60 AS \"right\", top + 20 AS bottom FROM {_TOK} WHERE conf > 50",
    "special_ids": f"""WITH t AS MATERIALIZED (SELECT * FROM {_TOK} WHERE conf > 50),
p AS (SELECT a.page, a.text || b.text AS id FROM t a JOIN t b ON a.page = b.page AND length(a.text) = 6 AND length(b.text) = 1 AND b."left" >= a."left" + 60 QUALIFY row_number() OVER (PARTITION BY a.page ORDER BY a.pos, sqrt((b."left" - a."left" - 60) ^ 2 + (b.top - a.top) ^ 2), b.pos) = 1),
s AS (SELECT page, text AS id FROM t WHERE length(text) = 7 AND text <> '1234567' QUALIFY row_number() OVER (PARTITION BY page ORDER BY pos) = 1)
SELECT page, coalesce(p.id, s.id) AS id FROM p FULL JOIN s USING (page)""",
    "box_corners": f"""WITH g AS (SELECT *, {_GX0} AS gx0, {_GX1} AS gx1, {_GY0} AS gy0, {_GY1} AS gy1 FROM {_LINES})
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, x0 AS x0, y0 AS y0, x1 AS x1, y0 AS y1, x1 AS x2, y1 AS y2, x0 AS x3, y1 AS y3, trunc(x0)::DOUBLE AS upright_xtl, trunc(y0)::DOUBLE AS upright_ytl, trunc(x1)::DOUBLE AS upright_xbr, trunc(y1)::DOUBLE AS upright_ybr,
  {_HX0}::DOUBLE + 0.0 AS close_xtl, {_HY0}::DOUBLE + 0.0 AS close_ytl, {_HX1}::DOUBLE + 0.0 AS close_xbr, {_HY1}::DOUBLE + 0.0 AS close_ybr, round(sqrt(floor((x0 + x1) / 2) ^ 2 + floor((y0 + y1) / 2) ^ 2), 6) AS away FROM g""",
    "close_quads": f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {', '.join(map(_quad_point, range(4)))} FROM {_LINES}",
    "page_transformations": f"""WITH m AS MATERIALIZED (SELECT *, sqrt(cx ^ 2 + cy ^ 2) AS o FROM {_MATCH} WHERE found), a AS (SELECT l_orderkey, cx AS ax, cy AS ay, cx + sx AS bx, cy + sy AS "by" FROM m QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY o, position) = 1),
f AS (SELECT l_orderkey, sx AS fx, sy AS fy FROM m QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY position) = 1),
z AS (SELECT a.*, cx AS px, cy AS py, cx + sx AS qx, cy + sy AS qy, sqrt((cx - ax) ^ 2 + (cy - ay) ^ 2) AS old FROM m JOIN a USING (l_orderkey) QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY sqrt((cx - ax) ^ 2 + (cy - ay) ^ 2) DESC, position) = 1),
n AS (SELECT l_orderkey, count(*) FILTER (WHERE found)::INT AS k FROM {_MATCH} GROUP BY 1), t AS (SELECT n.*, z.* EXCLUDE (l_orderkey), f.fx, f.fy, k >= 2 AND old > 0 AS ok FROM n LEFT JOIN z USING (l_orderkey) LEFT JOIN f USING (l_orderkey))
SELECT l_orderkey, CASE WHEN ok THEN round(sqrt((bx - qx) ^ 2 + ("by" - qy) ^ 2) / old, 6) ELSE 1 END AS scale, CASE WHEN ok THEN fx ELSE 0 END AS shift_x, CASE WHEN ok THEN fy ELSE 0 END AS shift_y,
  CASE WHEN ok THEN round(degrees(({_SLOPE.format(a='b', b='q').replace('by', '"by"')}) - ({_SLOPE.format(a='a', b='p')})), 6) + 0.0 ELSE 0 END AS degrees, CASE WHEN ok THEN ax ELSE 0 END AS reference_x, CASE WHEN ok THEN ay ELSE 0 END AS reference_y, k AS n_matched FROM t""",
    "page_extra_shifts": f"SELECT l_orderkey, count(*) FILTER (WHERE found) >= 2 AS aligned, {', '.join(f'coalesce({f}({c}) FILTER (WHERE found), 0)::DOUBLE AS {n}' for f, c, n in (('max', 'sx', 'most_x'), ('min', 'sx', 'least_x'), ('max', 'sy', 'most_y'), ('min', 'sy', 'least_y')))} FROM {_MATCH} GROUP BY 1",
    "archive_pages": f"SELECT archive, regexp_extract(member, '([0-9]+)[.]png$', 1)::INT AS page, min(member) AS member FROM {_MEM} WHERE regexp_matches(member, '[0-9]+[.]png$') GROUP BY 1, 2",
    "archive_waves": f"SELECT archive, string_agg(q::VARCHAR, ',' ORDER BY q) AS qs FROM (SELECT DISTINCT archive, regexp_extract(member, '^q([0-9]+)/', 1)::INT AS q FROM {_MEM}) GROUP BY 1",
    "archive_modalities": f"SELECT DISTINCT archive, regexp_extract(member, '^q([0-9]+)/', 1)::INT AS q, regexp_extract(member, '([^/]+)[.]png$', 1) AS modality, CASE regexp_extract(member, '([^/]+)[.]png$', 1) WHEN 'hand' THEN 1 WHEN 'page_1' THEN 2 ELSE 3 END::BIGINT AS position FROM {_MEM}",
    "archive_member": f"SELECT archive, min(member) AS member, arg_min(n_bytes, member) AS n_bytes FROM {_MEM} WHERE member = 'hand.png' OR suffix(member, '/hand.png') GROUP BY 1",
    "scan_names": """WITH p AS (SELECT file_path || '_' || file_id % 37 || '.png' AS path, (file_id % 37)::INT AS page FROM page_file)
SELECT path, page, regexp_extract(path, '[^/]*$') AS name, regexp_replace(regexp_extract(path, '[^/]*$'), '[.][^.]*$', '') AS stem, regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder FROM p""",
    "scan_folders": "SELECT DISTINCT regexp_extract(file_path, '^(.*)/[^/]*$', 1) AS folder FROM page_file WHERE NOT starts_with(regexp_extract(regexp_extract(file_path, '^(.*)/[^/]*$', 1), '[^/]*$'), '.')",
    "subject_row": "WITH r AS (SELECT unique_id, max(last_avail_q) AS last_avail_q FROM training GROUP BY 1), k AS (SELECT min(split_part(unique_id, '_', 1)) AS k FROM r) SELECT r.* FROM r, k WHERE unique_id = k OR split_part(unique_id, '_', 1) = k ORDER BY unique_id <> k, unique_id LIMIT 1",
    "subject_descriptions": "SELECT DISTINCT unique_id, 4 AS n_facts, split, relative_age::VARCHAR AS relative_age, coalesce(birth_date::VARCHAR, '-') AS born FROM training",
    "wave_windows": "SELECT date_trunc('day', logged_at)::TIMESTAMP AS day, q, count(*) AS n FROM combined_success_ids WHERE logged_at IS NOT NULL GROUP BY ALL",
    "text_normal_form": r"SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name || '  & ' || upper(p_type) || ' (#1)' || chr(9) || '!'), '[^\w\s.,:;\-()/%]', ' ', 'g'), '\s+', ' ', 'g')) AS normal FROM part",
}
