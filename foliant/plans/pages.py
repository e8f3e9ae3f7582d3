"""Run logs, texts, page assignment, boxes and annotations over the test tables, some of which stand in for scans.

The `part` table's names stand in for texts of pages, `embeddings` for pages' hashes (64 signs), and `lineitem`'s numbers for boxes of a page per order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import text
from ..operators import annotations, boxes, page_matching, runs
from ..session import cut, table

CLASSES = {"censor": 0, "censor_close": 1, "roi": 2, "align": 3}


def run_time_stats(spark, d):
    return runs.time_stats(table(spark, d, "events"), "value")


def longest_runs(spark, d):
    return runs.longest(table(spark, d, "events"), "event_id", "value")


def last_run_counts(spark, d):
    """Values of two columns over each subject's last scan."""
    last = runs.last_per_id(table(spark, d, "manifest").select("e3n_id_hand", "row_id", "received_at", "warning_ordering", "warning_censoring"), "e3n_id_hand", ["received_at", "row_id"])
    return runs.value_counts(last, ["warning_ordering", "warning_censoring"])


def grouped_mode_accuracy(spark, d):
    """Whether a subject's most frequent wave in file names is the most frequent one of its rows."""
    rows = table(spark, d, "manifest").withColumn("named", F.nullif(F.regexp_extract(F.lower("object_name"), "q0*([0-9]+)", 1), F.lit("")))
    return runs.mode_accuracy(rows, "e3n_id_hand", "named", "q").withColumn("accuracy", F.round("accuracy", 9))


def row_accuracy(spark, d):
    rows = table(spark, d, "manifest").withColumn("named", F.nullif(F.regexp_extract(F.lower("object_name"), "q0*([0-9]+)", 1), F.lit("")))
    return rows.agg(F.round(runs.accuracy(F.col("named"), F.col("q").cast("string")), 9).alias("accuracy"))


def id_extract(spark, d):
    return table(spark, d, "documents").select("doc_id", text.target_number(F.col("text")).alias("found"))


def token_similarity(spark, d):
    """Jaccard and containment of each name with its brand and type, in lower case."""
    rows = table(spark, d, "part").select("p_partkey", F.lower("p_name").alias("a"), F.lower(F.concat_ws(" ", F.split("p_name", " ")[0], F.col("p_type"), F.col("p_brand"))).alias("b"))
    return rows.select("p_partkey", F.round(text.jaccard(F.col("a"), F.col("b")), 9).alias("jaccard"), F.round(text.containment(F.col("a"), F.col("b")), 9).alias("containment"))


def text_comparison(spark, d):
    """Normal forms and all similarities of distinct names and types; sequences have no SQL."""
    rows = table(spark, d, "part").select("p_name", "p_type").distinct()
    return rows.select("p_name", "p_type", text.compare(F.col("p_name"), F.col("p_type")).alias("c")).select("p_name", "p_type", "c.norm_a", "c.norm_b", "c.sequence", "c.jaccard", "c.containment")


def palette(spark, d):
    return table(spark, d, "part").select("p_type", text.palette_index(F.col("p_type")).alias("color")).distinct()


def _hashes(spark, d):
    """64 signs against the median of all but the first value, as bits."""
    e = F.col("embedding")
    median = F.get(F.array_sort(F.slice(e, 2, 63)), F.lit(31))
    ones = lambda m: F.transform(e, lambda x, i: F.when(x > m, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    bits = lambda m: F.aggregate(ones(m), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    # The median is bound as a variable, as its expression would be sorted again for each value.
    return table(spark, d, "embeddings").select("vec_id", F.col("label").cast("long").alias("label"), F.get(F.transform(F.array(median), bits), F.lit(0)).alias("hash"))


def phash_bits(spark, d):
    return _hashes(spark, d).select("vec_id", F.bit_count("hash").alias("n_bits"), F.lpad(F.hex("hash"), 16, "0").alias("hash"))


def _costs(spark, d):
    """Labels stand for questionnaires: the vectors of a label and a hundred numbers for a document's pages, the first vector of
    each label and number modulo twelve for a template."""
    h = _hashes(spark, d)
    doc, page = F.col("label") * 1_000_000_000 + F.floor(F.col("vec_id") / 100), F.col("vec_id") % 100
    pages = h.select(doc.alias("doc"), page.alias("page"), F.col("label").alias("q"), "hash")
    templates = h.groupBy(F.col("label").alias("q"), (F.col("vec_id") % 12).alias("template")).agg(F.min_by("hash", "vec_id").alias("hash"))
    return page_matching.hash_costs(pages, templates)


def phash_costs(spark, d):
    return _costs(spark, d)


def page_assignment(spark, d):
    return page_matching.assign_pages(_costs(spark, d))


def assignment_report(spark, d):
    costs = cut(_costs(spark, d))
    return page_matching.report(costs, page_matching.assign_pages(costs))


def assignment_gaps(spark, d):
    """The report for the nearest template of each page, in place of an assignment."""
    costs = _costs(spark, d)
    nearest = costs.groupBy("doc", "page").agg(F.min_by("template", F.struct("cost", "template")).alias("template"), F.min("cost").alias("cost"))
    return page_matching.report(costs, nearest)


def select_template(spark, d):
    """The half of the templates that is nearer in sum to each document."""
    rows = _costs(spark, d).withColumn("variant", F.when(F.col("template") < 6, "a").otherwise("b"))
    totals = rows.groupBy("doc", "variant").agg(F.sum("cost").alias("total")).withColumn("position", F.when(F.col("variant") == "a", 0).otherwise(1))
    return page_matching.select_template(totals)


def discover_template(spark, d):
    """The template with the most pages within 28 bits."""
    good = _costs(spark, d).groupBy("doc", "template").agg(F.count_if(F.col("cost") < 28).alias("n_good"))
    return page_matching.discover(good.select("doc", F.lit("t").alias("variant"), "template", "n_good", F.col("template").alias("position")))


def page_cascade(spark, d):
    """Three stages: near hashes hold pages in place, then by distance, then by distances of the other order as texts."""
    costs = cut(_costs(spark, d))
    pages, templates = costs.select("doc", "page").distinct(), costs.select("doc", "template").distinct()
    verified = costs.where("cost < 28").select("doc", "page", "template")
    return page_matching.cascade(pages, templates, verified, costs, costs.withColumn("cost", F.round(F.col("cost") / 64, 6)))


def expected_pages(spark, d):
    """Pages to take of each subject's and wave's files, with one to six pages each by their numbers."""
    files = table(spark, d, "manifest").where("object_name IS NOT NULL AND e3n_id_hand IS NOT NULL AND q IS NOT NULL")
    files = files.groupBy(F.concat_ws("/", "e3n_id_hand", F.col("q").cast("string")).alias("doc"), "q", F.col("object_name").alias("file")).agg((F.min("row_id") % 7).cast("int").alias("n_pages"))
    return page_matching.expected_pages(files, page_matching.questionnaires(spark))


def _boxes(spark, d, outer: bool):
    """Boxes of a page per order, one per line: small ones, or large ones about the same place."""
    rows = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*(F.min(c).alias(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_returnflag")))
    off, size = (250, 600) if outer else (0, 40)
    x, y = F.col("l_partkey") % 500, F.col("l_suppkey") % 50 * 10
    return rows.select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("no"), g.box(x - off, y - off, x + size, y + F.col("l_quantity")).alias("box"), (F.col("l_returnflag") == "R").alias("partial"))


def box_containment(spark, d):
    return boxes.smallest_containing(_boxes(spark, d, False), _boxes(spark, d, True), ["page"])


def box_overlap(spark, d):
    return boxes.covering(_boxes(spark, d, False), _boxes(spark, d, True), ["page"]).withColumn("covered", F.round("covered", 9))


def censor_boxes(spark, d):
    return boxes.censor_boxes(_boxes(spark, d, False), _boxes(spark, d, True), ["page"]).select("page", "inner_no", "outer_no", "partial", "box.*")


def box_columns(spark, d):
    """Rescaled, enlarged and snapped boxes, and their centres and areas."""
    b, old, new = F.col("box"), (F.lit(600), F.lit(800)), (F.lit(1240), F.lit(1754))
    made = {"scaled": g.rescale(b, old, new), "larger": g.enlarge(b, F.lit(1.5), old), "snapped": g.snap(b, (F.lit(540.0), F.lit(490.0)), (F.lit(700.0), F.lit(900.0)))}
    cols = [F.col(f"{n}.{s}").cast("double").alias(f"{n}_{s}") for n in made for s in g.SIDES]
    return _boxes(spark, d, False).withColumns(made).select("page", "no", *cols, g.area(b).alias("area"), g.center(b)["x"].alias("cx"), g.center(b)["y"].alias("cy"))


def box_transforms(spark, d):
    """Boxes shifted, scaled by their number and turned about a point, as corners, and the test of their shape."""
    b = F.col("box")
    pts = g.similarity(b, g.point(F.lit(10), F.lit(20)), 0.5 + F.col("no") / 5, F.lit(3.0), F.lit(-2.0), F.lit(4.0))
    corner = [F.round(F.get("pts", F.lit(k))[a], 6).alias(f"{a}{k}") for k in range(4) for a in "xy"]
    return _boxes(spark, d, False).withColumn("pts", pts).select("page", "no", *corner, g.validity(F.col("pts"), g.width(b), g.height(b)).alias("verdict"))


def quad_validity(spark, d):
    """What is wrong with corners that a line's numbers push from those of a square of 100."""
    a, b = F.col("l_partkey") % 41 - 20, F.col("l_suppkey") % 37 * 4 - 40
    pts = F.array(g.point(F.lit(0), F.lit(0)), g.point(100 + a, a / 2), g.point(100 + b, 100 - b), g.point(b / 4, F.lit(100)))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", pts.alias("pts"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", g.validity(F.col("pts"), F.lit(100.0), F.lit(100.0)).alias("verdict"))


def yolo_rows(spark, d):
    """Centre and size of boxes in percent, and the percent again."""
    p = {"x": F.col("l_quantity"), "y": F.col("l_discount") * 100, "width": F.col("l_tax") * 100, "height": F.col("l_linenumber") + 1.0}
    y = g.yolo(p)
    back = g.from_yolo(*y.values())
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *(F.round(c, 9).alias(k) for k, c in y.items()), *(F.round(c, 6).alias(f"back_{k}") for k, c in back.items()))


def annotation_pages(spark, d):
    rows = annotations.pages(table(spark, d, "doc_5"), "body", ["record_id"])
    return rows.select("record_id", "page", "page_pos", "image_type", F.size("label").alias("n_boxes"), F.concat_ws(",", "roi_type").alias("roi_types"))


def annotation_regions(spark, d):
    rows = annotations.regions(annotations.pages(table(spark, d, "doc_5"), "body", ["record_id"]), ["record_id"])
    return rows.select("record_id", "page", "box_no", "label", "sub_attribute", "x", "y", "width", "height")


def label_files(spark, d):
    """Label files of the labelling tool's exports."""
    return annotations.label_rows(table(spark, d, "doc_5"), "body", "record_id", CLASSES, r"\\\\|/")


_BITS = "SELECT vec_id, label, embedding AS e, list_sort(embedding[2:64]) AS s FROM embeddings"
_HASH = f"SELECT vec_id, label, array_to_string(list_transform(list_reverse(e), lambda x: CASE WHEN x > s[32] THEN '1' ELSE '0' END), '') AS h FROM ({_BITS})"
_COSTS = f"""SELECT a.label::BIGINT * 1000000000 + a.vec_id // 100 AS doc, a.vec_id % 100 AS page, b.template, hamming(a.h, b.h)::DOUBLE AS cost FROM ({_HASH}) a JOIN (SELECT label, vec_id % 12 AS template, arg_min(h, vec_id) AS h FROM ({_HASH}) GROUP BY 1, 2) b USING (label)"""
_NAMED = "SELECT e3n_id_hand AS k, q::VARCHAR AS t, nullif(regexp_extract(lower(object_name), 'q0*([0-9]+)', 1), '') AS f FROM manifest"


def _box(outer: bool) -> str:
    off, size = (250, 600) if outer else (0, 40)
    return f"(SELECT l_orderkey AS page, l_linenumber AS no, (l_partkey % 500 - {off})::DOUBLE AS x0, (l_suppkey % 50 * 10 - {off})::DOUBLE AS y0, (l_partkey % 500 + {size})::DOUBLE AS x1, l_suppkey % 50 * 10 + l_quantity AS y1, l_returnflag = 'R' AS partial FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey, min(l_quantity) AS l_quantity, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1, 2))"


_COVER = "CASE WHEN (i.x1 - i.x0) * (i.y1 - i.y0) > 0 THEN greatest(least(i.x1, o.x1) - greatest(i.x0, o.x0), 0) * greatest(least(i.y1, o.y1) - greatest(i.y0, o.y0), 0) / ((i.x1 - i.x0) * (i.y1 - i.y0)) ELSE 0 END"
_SNAP = "CASE WHEN {v} >= {a} - 2 THEN {z} WHEN {v} <= 2 THEN 0 ELSE {v} END::DOUBLE"

QUERIES = {
    f.__name__: f
    for f in (
        run_time_stats, longest_runs, last_run_counts, grouped_mode_accuracy, row_accuracy, id_extract, token_similarity, text_comparison, palette, phash_bits, phash_costs,
        page_assignment, assignment_report, assignment_gaps, select_template, discover_template, page_cascade, expected_pages, box_containment, box_overlap, censor_boxes,
        box_columns, box_transforms, quad_validity, yolo_rows, annotation_pages, annotation_regions, label_files,
    )
}


def _large(lo: str, hi: str, size: int) -> tuple[str, str]:
    mid, half = f"(({lo} + {hi}) / 2)", f"(({hi} - {lo}) * 1.5 / 2)"
    return f"trunc(greatest({mid} - {half} - greatest({mid} + {half} - {size}, 0), 0))::DOUBLE", f"trunc(least({mid} + {half} + greatest({half} - {mid}, 0), {size}))::DOUBLE"


(_LX0, _LX1), (_LY0, _LY1) = _large("x0", "x1", 600), _large("y0", "y1", 800)
_TURN = """SELECT page, no, 0.5 + no / 5 AS k, x1 - x0 AS w, y1 - y0 AS h, (x0 + x1) / 2 + 3 AS cx, (y0 + y1) / 2 - 2 AS cy FROM {b}"""
_ANGLE = "radians(-4)"


def _corner(sx: int, sy: int) -> tuple[str, str]:
    dx, dy = f"(cx + {sx} * w * k / 2 - 10)", f"(cy + {sy} * h * k / 2 - 20)"
    return f"round(10 + {dx} * cos({_ANGLE}) - {dy} * sin({_ANGLE}), 6)", f"round(20 + {dx} * sin({_ANGLE}) + {dy} * cos({_ANGLE}), 6)"


_CORNERS = ", ".join(f"{x} AS x{k}, {y} AS y{k}" for k, (x, y) in enumerate(_corner(*s) for s in ((-1, -1), (1, -1), (1, 1), (-1, 1))))
def _at(k: int) -> tuple[str, str]:
    return f"x[{k % 4 + 1}]", f"y[{k % 4 + 1}]"


def _cross(k: int) -> str:
    (ax, ay), (bx, by), (cx, cy) = (_at(k), _at(k + 1), _at(k + 2))
    return f"(({bx} - {ax}) * ({cy} - {by}) - ({by} - {ay}) * ({cx} - {bx}))"


def _bend(k: int) -> str:
    """Degrees that the corner between its neighbours is off a right angle."""
    (ax, ay), (bx, by), (cx, cy) = (_at(k - 1), _at(k), _at(k + 1))
    dot, size = f"(({ax} - {bx}) * ({cx} - {bx}) + ({ay} - {by}) * ({cy} - {by}))", f"(sqrt(({ax} - {bx}) ^ 2 + ({ay} - {by}) ^ 2) * sqrt(({cx} - {bx}) ^ 2 + ({cy} - {by}) ^ 2))"
    return f"abs(degrees(acos(greatest(-1, least(1, {dot} / {size})))) - 90)"


_CROSSES, _BENDS = ", ".join(map(_cross, range(4))), ", ".join(map(_bend, range(4)))
_TWICE = " + ".join(f"x[{k + 1}] * y[{(k + 1) % 4 + 1}] - x[{(k + 1) % 4 + 1}] * y[{k + 1}]" for k in range(4))
_QUADS = f"""WITH n AS (SELECT *, l_partkey % 41 - 20 AS a, l_suppkey % 37 * 4 - 40 AS b FROM lineitem), q AS (SELECT *, [0, 100.0 + a, 100.0 + b, b / 4] AS x, [0, a / 2, 100.0 - b, 100] AS y FROM n)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN least({_CROSSES}) * greatest({_CROSSES}) < 0 THEN 'convex' WHEN abs({_TWICE}) / 2 NOT BETWEEN 4000 AND 16000 THEN 'area' WHEN greatest({_BENDS}) > 10 THEN 'angle' ELSE 'ok' END AS verdict FROM q"""
_ANNOTATED = """WITH b AS (SELECT record_id, body::JSON AS body FROM doc_5 WHERE json_valid(body)), e AS (SELECT record_id, CASE json_type(body) WHEN 'ARRAY' THEN json_extract(body, '$[*]') ELSE [body] END AS ps FROM b),
q AS (SELECT record_id, unnest(ps) AS p, (generate_subscripts(ps, 1) - 1)::INT AS page_pos FROM e), m AS (SELECT *, nullif(regexp_extract(p ->> '$.image', 'page_([0-9]+)[.]png$', 1), '')::INT AS page FROM q WHERE json_type(p) = 'OBJECT'),
pages AS (SELECT *, CASE WHEN json_type(p -> '$.label') = 'ARRAY' THEN json_array_length(p -> '$.label')::INT END AS n_boxes FROM m WHERE page IS NOT NULL QUALIFY row_number() OVER (PARTITION BY record_id, page ORDER BY page_pos) = 1)"""
_LISTED = "CASE json_type(p -> '$.{c}') WHEN 'ARRAY' THEN array_to_string(list_transform(json_extract(p, '$.{c}[*]'), lambda j: j ->> '$'), ',') WHEN 'NULL' THEN '' ELSE coalesce(p ->> '$.{c}', '') END"
_NTH = "CASE json_type(p -> '$.{c}') WHEN 'ARRAY' THEN json_extract(p, '$.{c}[*]')[n] ->> '$' WHEN 'NULL' THEN NULL ELSE CASE WHEN n = 1 THEN p ->> '$.{c}' END END"
SQL = {
    "run_time_stats": "SELECT count(value) AS n, avg(value) AS mean_time, max(value) AS most_time, count(*) FILTER (WHERE value > 100) AS n_above FROM events",
    "longest_runs": "SELECT event_id, value FROM events WHERE value IS NOT NULL ORDER BY value DESC, event_id LIMIT 5",
    "last_run_counts": """WITH l AS (SELECT * FROM manifest WHERE e3n_id_hand IS NOT NULL QUALIFY row_number() OVER (PARTITION BY e3n_id_hand ORDER BY received_at DESC, row_id DESC) = 1)
SELECT column_name, value, count(*) AS n FROM (SELECT 'warning_ordering' AS column_name, warning_ordering AS value FROM l UNION ALL SELECT 'warning_censoring', warning_censoring FROM l) WHERE value IS NOT NULL GROUP BY 1, 2""",
    "grouped_mode_accuracy": f"""
WITH r AS ({_NAMED}), a AS (SELECT k, f AS v FROM r WHERE k IS NOT NULL AND f IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, f) = 1),
b AS (SELECT k, t AS v FROM r WHERE k IS NOT NULL AND t IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, t) = 1), k AS (SELECT DISTINCT k FROM r WHERE k IS NOT NULL)
SELECT count(*) AS n_groups, round(coalesce(avg(coalesce((a.v = b.v)::INT, 0)), 0), 9) AS accuracy FROM k LEFT JOIN a USING (k) LEFT JOIN b USING (k)""",
    "row_accuracy": f"SELECT round(avg(coalesce((f = t)::INT, 0)), 9) AS accuracy FROM ({_NAMED})",
    "id_extract": r"""WITH m AS (SELECT doc_id, text, regexp_extract(text, '[0-9]{6}\s*[0-9]') AS s, regexp_extract_all(text, '[0-9]+') AS r FROM documents)
SELECT doc_id, CASE WHEN s <> '' THEN replace(s, ' ', '') ELSE list_extract(list_filter(r, lambda x: length(x) = list_max(list_transform(r, lambda z: length(z)))), 1) END AS found FROM m""",
    "token_similarity": """WITH t AS (SELECT p_partkey, list_distinct(string_split(lower(p_name), ' ')) AS a, list_distinct(string_split(lower(split_part(p_name, ' ', 1) || ' ' || p_type || ' ' || p_brand), ' ')) AS b FROM part)
SELECT p_partkey, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 9) AS jaccard, round(len(list_intersect(a, b)) / least(len(a), len(b)), 9) AS containment FROM t""",
    "palette": "SELECT DISTINCT p_type, (list_sum(list_transform(string_split(p_type, ''), lambda c: ord(c))) % 10)::INT AS color FROM part",
    "phash_bits": f"SELECT vec_id, (length(h) - length(replace(h, '1', '')))::INT AS n_bits, lpad(array_to_string(list_transform(range(0, 16), lambda k: substr('0123456789ABCDEF', (ord(substr(h, k * 4 + 1, 1)) - 48) * 8 + (ord(substr(h, k * 4 + 2, 1)) - 48) * 4 + (ord(substr(h, k * 4 + 3, 1)) - 48) * 2 + (ord(substr(h, k * 4 + 4, 1)) - 48) + 1, 1)), ''), 16, '0') AS hash FROM ({_HASH})",
    "phash_costs": _COSTS,
    "assignment_gaps": f"""WITH c AS MATERIALIZED ({_COSTS}), r AS (SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY cost, template) AS i FROM c)
SELECT a.doc, a.page, a.template, a.cost::BIGINT AS best, b.cost::BIGINT AS second_best, (b.cost - a.cost)::BIGINT AS gap, a.cost::BIGINT AS chosen, b.cost - a.cost >= 5 AND a.cost <= 18 AS ok FROM r a JOIN r b ON a.doc = b.doc AND a.page = b.page WHERE a.i = 1 AND b.i = 2""",
    "select_template": f"SELECT doc, CASE WHEN sum(cost) FILTER (WHERE template < 6) <= sum(cost) FILTER (WHERE template >= 6) THEN 'a' ELSE 'b' END AS variant FROM ({_COSTS}) GROUP BY doc",
    "discover_template": f"SELECT doc, 't' AS variant, template FROM ({_COSTS}) WHERE cost < 28 GROUP BY doc, template QUALIFY row_number() OVER (PARTITION BY doc ORDER BY count(*) DESC, template) = 1",
    "box_containment": f"SELECT i.page, i.no AS inner_no, arg_min(o.no, (o.x1 - o.x0) * (o.y1 - o.y0) * 1000 + o.no) AS outer_no FROM {_box(False)} i LEFT JOIN {_box(True)} o ON o.page = i.page AND o.x0 <= i.x0 AND o.y0 <= i.y0 AND o.x1 >= i.x1 AND o.y1 >= i.y1 GROUP BY 1, 2",
    "box_overlap": f"SELECT i.page, i.no AS inner_no, o.no AS outer_no, round({_COVER}, 9) AS covered FROM {_box(False)} i JOIN {_box(True)} o ON o.page = i.page WHERE {_COVER} >= 0.5",
    "censor_boxes": f"""SELECT i.page, i.no AS inner_no, o.no AS outer_no, o.partial, CASE WHEN o.partial THEN greatest(i.x0, o.x0) ELSE i.x0 END AS xtl, CASE WHEN o.partial THEN greatest(i.y0, o.y0) ELSE i.y0 END AS ytl,
  CASE WHEN o.partial THEN least(i.x1, o.x1) ELSE i.x1 END AS xbr, CASE WHEN o.partial THEN least(i.y1, o.y1) ELSE i.y1 END AS ybr FROM {_box(False)} i JOIN {_box(True)} o ON o.page = i.page WHERE {_COVER} >= 0.5""",
    "box_columns": f"""SELECT page, no, {', '.join(f"trunc({v} * ({n}::DOUBLE / {o}))::DOUBLE AS scaled_{s}" for v, s, n, o in (('x0', 'xtl', 1240, 600), ('y0', 'ytl', 1754, 800), ('x1', 'xbr', 1240, 600), ('y1', 'ybr', 1754, 800)))},
  {_LX0} AS larger_xtl, {_LY0} AS larger_ytl, {_LX1} AS larger_xbr, {_LY1} AS larger_ybr,
  {', '.join(f'{_SNAP.format(v=v, a=a, z=z)} AS snapped_{s}' for v, s, a, z in (('x0', 'xtl', 540, 700), ('y0', 'ytl', 490, 900), ('x1', 'xbr', 540, 700), ('y1', 'ybr', 490, 900)))},
  (x1 - x0) * (y1 - y0) AS area, floor((x0 + x1) / 2) AS cx, floor((y0 + y1) / 2) AS cy FROM {_box(False)}""",
    "box_transforms": f"SELECT page, no, {_CORNERS}, CASE WHEN k * k < 0.4 OR k * k > 1.6 THEN 'area' ELSE 'ok' END AS verdict FROM ({_TURN.format(b=_box(False))})",
    "quad_validity": _QUADS,
    "annotation_pages": f"{_ANNOTATED} SELECT record_id, page, page_pos, coalesce(p ->> '$.image_type', '') AS image_type, n_boxes, {_LISTED.format(c='roi_type')} AS roi_types FROM pages",
    "annotation_regions": f"""{_ANNOTATED}, bx AS (SELECT *, unnest(json_extract(p, '$.label[*]')) AS v, generate_subscripts(json_extract(p, '$.label[*]'), 1) - 1 AS box_no FROM pages WHERE n_boxes > 0),
l AS (SELECT *, CASE json_type(v -> '$.rectanglelabels') WHEN 'ARRAY' THEN v ->> '$.rectanglelabels[0]' WHEN 'NULL' THEN NULL ELSE v ->> '$.rectanglelabels' END AS label FROM bx),
n AS (SELECT *, row_number() OVER (PARTITION BY record_id, page, label ORDER BY box_no) AS n FROM l)
SELECT record_id, page, box_no::INT AS box_no, label, CASE label WHEN 'roi' THEN {_NTH.format(c='roi_type')} WHEN 'censor' THEN {_NTH.format(c='censor_type')} WHEN 'censor-close' THEN {_NTH.format(c='close_type')} WHEN 'censor_close' THEN {_NTH.format(c='close_type')} END AS sub_attribute,
  {', '.join(f"CASE WHEN json_type(v -> '$.{c}') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN (v ->> '$.{c}')::DOUBLE END AS {c}" for c in ('x', 'y', 'width', 'height'))} FROM n""",
    "label_files": f"""{_ANNOTATED}, t AS (SELECT record_id, page_pos AS i, p, string_split(p ->> '$.data.image', '/') AS parts FROM q WHERE p ->> '$.data.image' IS NOT NULL),
n AS (SELECT *, regexp_replace(array_to_string(parts[greatest(len(parts) - 1, 1):], '_'), '[.][^.]*$', '') AS name FROM t), k AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY record_id, i) - 1 AS nth FROM n),
f AS (SELECT CASE WHEN nth = 0 THEN name ELSE name || '_' || nth END AS file_name, list_filter(flatten(list_transform(coalesce(json_extract(p, '$.annotations[*]'), []), lambda a: coalesce(json_extract(a, '$.result[*]'), []))), lambda r: r ->> '$.type' = 'rectanglelabels') AS rs FROM k),
v AS (SELECT file_name, (u - 1)::INT AS box_no, rs[u] -> '$.value' AS v FROM f, unnest(range(1, len(rs) + 1)) g(u)),
r AS (SELECT *, {', '.join(f"try_cast(replace(replace(rtrim(trim(v ->> '$.{c}'), '%'), ',', '.'), ' ', '') AS DOUBLE) AS {c}" for c in ('x', 'y', 'width', 'height'))} FROM v)
SELECT file_name, box_no, CASE WHEN x + y + width + height IS NOT NULL THEN printf('%d %.6f %.6f %.6f %.6f', CASE v ->> '$.rectanglelabels[0]' {' '.join(f"WHEN '{c}' THEN {n}" for c, n in CLASSES.items())} ELSE 0 END, (x + width / 2) / 100, (y + height / 2) / 100, width / 100, height / 100) END AS line FROM r
UNION ALL SELECT file_name, NULL, NULL FROM f WHERE len(rs) = 0""",
    "expected_pages": f"""
WITH f AS (SELECT e3n_id_hand || '/' || q AS doc, q, object_name AS file, (min(row_id) % 7)::INT AS n_pages FROM manifest WHERE object_name IS NOT NULL AND e3n_id_hand IS NOT NULL AND q IS NOT NULL GROUP BY 1, 2, 3),
k(q, num_pages, reverse) AS (VALUES {', '.join(f'({q}, {n}, {r})' for q, (n, r, _) in page_matching.QUESTIONNAIRES.items())}),
r AS (SELECT f.*, num_pages, reverse, CASE WHEN reverse THEN -1 ELSE 1 END * row_number() OVER (PARTITION BY doc ORDER BY file) AS place FROM f JOIN k USING (q) WHERE n_pages > 0),
b AS (SELECT * FROM r WHERE n_pages > 1 QUALIFY row_number() OVER (PARTITION BY doc ORDER BY n_pages DESC, place) = 1),
o AS (SELECT doc, 0 AS part, j AS k, file, CASE WHEN reverse THEN n_pages - 1 - j ELSE j END AS page_index FROM b, range(0, 7) t(j) WHERE j < n_pages
  UNION ALL SELECT r.doc, 1, r.place, r.file, 0 FROM r LEFT JOIN b USING (doc) WHERE r.n_pages = 1 AND coalesce(b.n_pages, 0) < r.num_pages)
SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY part, k)::INT AS position, file, page_index::INT AS page_index FROM o""",
    "yolo_rows": """SELECT l_orderkey, l_linenumber, round((l_quantity + l_tax * 100 / 2) / 100, 9) AS xc, round((l_discount * 100 + (l_linenumber + 1) / 2) / 100, 9) AS yc, round(l_tax, 9) AS w, round((l_linenumber + 1) / 100, 9) AS h,
  round(l_quantity, 6) AS back_x, round(l_discount * 100, 6) AS back_y, round(l_tax * 100, 6) AS back_width, (l_linenumber + 1)::DOUBLE AS back_height FROM lineitem""",
}
