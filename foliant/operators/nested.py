"""Deeply nested records as related flat tables."""

from __future__ import annotations

import json
import math
from collections.abc import Collection, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import strict_json

Ordinals = tuple[int, ...]


def triples(value, lists: Collection[str] = (), embedded: Collection[str] = (), path: str = "", at: Ordinals = ()) -> Iterator[tuple[str, Ordinals, object]]:
    """A record's (path, ordinals, scalar), in its own order. `[]` in a path stands for an array, with one ordinal each.

    Fields named in `lists` count as arrays even if the record holds a single value; texts of fields in `embedded` are read
    as JSON if they are. Objects and arrays give a triple of their own with value None, so that empty ones leave a row.
    """
    name = path.rpartition(".")[2]
    if name in embedded and isinstance(value, str):
        try:
            value = strict_json.loads(value)
        except ValueError:
            pass
    if name in lists and value is not None and not isinstance(value, list):
        value = [value]
    if isinstance(value, list):
        for k, v in enumerate(value):
            if v is not None:
                yield from triples(v, lists, embedded, path + "[]", (*at, k))
    elif isinstance(value, dict):
        yield path, at, None
        for k, v in value.items():
            yield from triples(v, lists, embedded, f"{path}.{k}" if path else k, at)
    else:
        yield path, at, value


def group(rows: Iterator[tuple[str, Ordinals, object]]) -> dict[str, dict[Ordinals, dict[str, object]]]:
    """Triples by repeated ancestor: for each path up to its last array, its rows by ordinals, with the fields below it."""
    out: dict[str, dict[Ordinals, dict[str, object]]] = {}
    for path, at, value in rows:
        head, mark, field = path.rpartition("[]")
        row = out.setdefault(head + mark, {}).setdefault(at, {})
        if value is not None:
            row[field.removeprefix(".")] = value
    return out


def _load(text: str | None):
    """The value of a JSON text, else None."""
    try:
        return strict_json.loads(text) if text is not None else None
    except ValueError:
        return None


def flatten(df: DataFrame, record_id: str, body: str, lists: Collection[str] = (), embedded: Collection[str] = ()) -> DataFrame:
    """All tables of the records in one frame: `record_id, table_path, ordinals, parent_path, parent_ordinals, fields`.

    A row links to its parent by record, parent path and parent ordinals. Null entries of arrays give no row but keep their
    ordinal; nulls and absent fields are absent from `fields`. Null, empty and invalid texts give no rows. Narrow: a
    record stays in its task and is read once.
    """
    lists, embedded = frozenset(lists), frozenset(embedded)
    kind = pa.schema([("record_id", pa.int64()), ("table_path", pa.string()), ("ordinals", pa.list_(pa.int64())), ("parent_path", pa.string()), ("parent_ordinals", pa.list_(pa.int64())), ("fields", pa.map_(pa.string(), pa.string()))])

    def run(batches):
        for batch in batches:
            out = []
            for rid, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                value = _load(text)
                if value is None:
                    continue
                for path, rows in group(triples(value, lists, embedded)).items():
                    parent = path[:-2].rpartition("[]")
                    for at, fields in rows.items():
                        text_of = [(k, v if isinstance(v, str) else json.dumps(v)) for k, v in fields.items()]
                        out.append((rid, path, at, parent[0] + parent[1] if path else None, at[:-1] if path else None, text_of))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * len(kind), kind, strict=True)], schema=kind)

    return df.select(F.col(record_id).cast("long"), F.col(body).cast("string")).mapInArrow(run, "record_id long, table_path string, ordinals array<long>, parent_path string, parent_ordinals array<long>, fields map<string,string>")


def tables(flat: DataFrame, most: int = 10_000) -> dict[str, DataFrame]:
    """Each repeated path of `flatten` as a table: `record_id`, a column `nK` for each ordinal, of which all but the last are the parent's, and a
    column for each field, in which `.` is `__`: a number if all its values are, else a text.

    Rows of a table and its parent's link by `record_id` and the ordinals they share. The vocabulary of paths and fields is
    collected; more than `most` fields raise an error. No rows give no tables. `flat` should be a written table, as each of the tables reads it.
    """
    number = F.expr("try_cast(value AS double)").isNotNull()
    cells = flat.select("table_path", F.size("ordinals").alias("depth"), F.explode_outer("fields").alias("field", "value"))
    rows = cells.groupBy("table_path", "depth", "field").agg(F.bool_and(number).alias("is_number")).orderBy("table_path", "field").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} fields")
    out = {}
    for path in dict.fromkeys(r.table_path for r in rows):
        own = [r for r in rows if r.table_path == path]
        fields = [F.col("fields")[r.field].cast("double" if r.is_number else "string").alias(r.field.replace(".", "__") or "value") for r in own if r.field is not None]
        out[path] = flat.where(F.col("table_path") == path).select("record_id", *(F.get("ordinals", F.lit(k)).alias(f"n{k}") for k in range(own[0].depth)), *fields)
    return out


def milli(value) -> int:
    """A number times 1000, rounded, however it is written; -1 if it can't be read."""
    if isinstance(value, str):
        try:
            value = float(value.strip().rstrip("%").replace(",", ".").replace(" ", ""))
        except ValueError:
            return -1
    if isinstance(value, bool) or not isinstance(value, int | float) or not math.isfinite(value):
        return -1
    return round(value * 1000)


#: The fields of annotation exports that hold lists, or a single value in place of a list of one.
LISTS = ("annotations", "result", "label", "rectanglelabels")
ROWS = "record_id long, page_pos long, image string, box_no long, label_no long, rectanglelabel string, x_milli long, y_milli long, width_milli long, height_milli long"


def _page_rows(value) -> Iterator[tuple]:
    """Rows of pages (box_no -1), boxes (label_no -1 if there is a label, too) and labels of one body."""
    pages = value if isinstance(value, list) else [value]
    for pos, page in enumerate(p for p in pages if isinstance(p, dict)):
        tables = group(triples(page, LISTS, ("label", "annotations")))
        top = tables.get("", {}).get((), {})
        image = top.get("image", top.get("data.image", ""))
        image = image if isinstance(image, str) else json.dumps(image)
        yield pos, image, -1, -1, "", -1, -1, -1, -1
        n = 0
        for path, prefix in (("label[]", ""), ("annotations[].result[]", "value.")):
            labels: dict[Ordinals, list[str]] = {}
            for at, row in tables.get(f"{path}.{prefix}rectanglelabels[]", {}).items():
                if "" in row:
                    labels.setdefault(at[:-1], []).append(row[""] if isinstance(row[""], str) else json.dumps(row[""]))
            for at, row in tables.get(path, {}).items():
                if "" in row or prefix and row.get("type") != "rectanglelabels":
                    continue  # no object, or another kind of result
                size = [milli(row.get(prefix + k)) for k in ("x", "y", "width", "height")]
                for k, label in enumerate(labels.get(at, ())):
                    yield pos, image, n, k, label, *size
                if at not in labels:
                    yield pos, image, n, -1, "", *size
                n += 1


def annotation_rows(df: DataFrame, record_id: str, body: str) -> DataFrame:
    """Pages, boxes and labels of annotation exports, each row with the keys and values of its ancestors.

    A page is a row with box_no -1. A box has a row per label, or one with label_no -1. A body is a page, a list of pages
    or a labelling tool's export; null pages, boxes and labels are not counted. Invalid bodies give no rows.
    """

    def run(batches):
        for batch in batches:
            out = []
            for rid, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                value = _load(text)
                if value is not None:
                    out += [(rid, *r) for r in _page_rows(value)]
            cols = list(zip(*out, strict=True)) if out else [[]] * 10
            yield pa.record_batch([pa.array(c, pa.string() if k in (2, 5) else pa.int64()) for k, c in enumerate(cols)], names=[x.split()[0] for x in ROWS.split(", ")])

    return df.select(F.col(record_id).cast("long"), F.col(body).cast("string")).mapInArrow(run, ROWS)
