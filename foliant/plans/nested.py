"""Problem 3: the annotation exports as tables of pages, boxes and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import nested as op
from ..session import cut, table


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return op.annotation_rows(table(spark, d, "doc_5"), "record_id", "body")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).where("box_no >= 0").select("record_id", "page_pos", "image", "box_no", "label_no", "rectanglelabel", "x_milli")


def p3_pages(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).where("box_no < 0").select("record_id", "page_pos", "image")


def p3_boxes(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).where("box_no >= 0 AND label_no <= 0").select("record_id", "page_pos", "box_no", "x_milli", "y_milli", "width_milli", "height_milli")


def p3_tables(spark: SparkSession, d: str) -> DataFrame:
    """Every repeated path of the bodies as rows with their parents' keys."""
    return op.flatten(table(spark, d, "doc_5"), "record_id", "body", op.LISTS, ("label",)).withColumn("fields", F.to_json("fields"))


def p3_label_table(spark: SparkSession, d: str) -> DataFrame:
    """The table of the boxes of lists of pages, with its typed columns."""
    flat = cut(op.flatten(table(spark, d, "doc_5"), "record_id", "body", op.LISTS, ("label",)))
    boxes = op.tables(flat)["[].label[]"]
    return boxes.select("record_id", "n0", "n1", *(F.col(c).cast("string").alias(c) for c in ("x", "y", "width", "height")))


QUERIES = {"p3_found": p3_found, "p3_pages": p3_pages, "p3_boxes": p3_boxes, "p3_tables": p3_tables, "p3_label_table": p3_label_table}


def _read(c: str) -> str:
    """A value as its entries: a text that is JSON is read, and a single value is a list of one."""
    v = f"CASE WHEN json_type({c}) = 'VARCHAR' AND json_valid({c} ->> '$') THEN ({c} ->> '$')::JSON ELSE {c} END"
    return _entries(f"({v})")


def _entries(v: str) -> str:
    return f"CASE WHEN {v} IS NULL OR json_type({v}) = 'NULL' THEN [] WHEN json_type({v}) = 'ARRAY' THEN json_extract({v}, '$[*]') ELSE [{v}] END"


def _milli(v: str) -> str:
    number = f"try_cast(CASE WHEN json_type({v}) = 'VARCHAR' THEN replace(replace(rtrim(trim({v} ->> '$'), '%'), ',', '.'), ' ', '') WHEN json_type({v}) IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN {v} ->> '$' END AS DOUBLE)"
    return f"coalesce(round_even({number} * 1000, 0)::BIGINT, -1)"


_PAGES = f"""b AS (SELECT record_id, body::JSON AS body FROM doc_5 WHERE json_valid(body)), e AS (SELECT record_id, CASE json_type(body) WHEN 'ARRAY' THEN json_extract(body, '$[*]') ELSE [body] END AS ps FROM b),
q AS (SELECT record_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM e),
pages AS (SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY i) - 1 AS page_pos, p, coalesce(p ->> '$.image', p ->> '$.data.image', '') AS image FROM q WHERE json_type(p) = 'OBJECT'),
l AS (SELECT record_id, page_pos, image, {_read("(p -> '$.label')")} AS es, {_read("(p -> '$.annotations')")} AS an FROM pages),
x AS (SELECT record_id, page_pos, image, 0 AS a, generate_subscripts(es, 1) AS i, unnest(es) AS r, '' AS kind FROM l),
an AS (SELECT record_id, page_pos, image, generate_subscripts(an, 1) AS a, unnest(an) AS v FROM l),
re AS (SELECT record_id, page_pos, image, a, {_entries("(v -> '$.result')")} AS rs FROM an WHERE json_type(v) = 'OBJECT'),
y AS (SELECT record_id, page_pos, image, a, generate_subscripts(rs, 1) AS i, unnest(rs) AS r FROM re),
boxes AS (SELECT record_id, page_pos, image, row_number() OVER (PARTITION BY record_id, page_pos ORDER BY a, i) - 1 AS box_no, v FROM (
  SELECT record_id, page_pos, image, a, i, r AS v FROM x WHERE json_type(r) = 'OBJECT' UNION ALL SELECT record_id, page_pos, image, a, i, r -> '$.value' FROM y WHERE json_type(r) = 'OBJECT' AND r ->> '$.type' = 'rectanglelabels'))"""
_SIZES = {n: _milli(f"(v -> '$.{n}')") for n in ("x", "y", "width", "height")}
SQL = {
    "p3_pages": f"WITH {_PAGES} SELECT record_id, page_pos, image FROM pages",
    "p3_boxes": f"WITH {_PAGES} SELECT record_id, page_pos, box_no, {', '.join(f'{m} AS {n}_milli' for n, m in _SIZES.items())} FROM boxes",
    "p3_found": f"""WITH {_PAGES}, k AS (SELECT *, list_filter({_entries("(v -> '$.rectanglelabels')")}, lambda j: json_type(j) NOT IN ('NULL', 'OBJECT', 'ARRAY')) AS ls FROM boxes)
SELECT record_id, page_pos, image, box_no, unnest(CASE WHEN len(ls) = 0 THEN [-1] ELSE range(0, len(ls)) END) AS label_no, unnest(CASE WHEN len(ls) = 0 THEN [''] ELSE list_transform(ls, lambda j: j ->> '$') END) AS rectanglelabel, {_SIZES['x']} AS x_milli FROM k""",
}
