"""Flat tables of nested records."""

import json

from foliant.operators import nested as op

BODIES = [
    (1, {"image": "p1", "label": [{"x": "1,5", "rectanglelabels": ["a", None, "b"]}, None, {"x": 2, "rectanglelabels": "c"}, {"rectanglelabels": []}]}),
    (2, [{"label": {"x": 0.0005}}, {"image": None, "label": json.dumps([{"x": None, "rectanglelabels": None}])}, {"image": "p3"}]),
    (3, {"data": {"image": "d"}, "annotations": [{"result": [{"type": "choices"}, {"type": "rectanglelabels", "value": {"x": 3, "rectanglelabels": ["q"]}}]}, None, {"result": [{"type": "rectanglelabels", "value": {"x": True}}]}]}),
    (4, []),
    (5, "text"),
]


def frame(spark):
    rows = [(k, json.dumps(b), "p") for k, b in BODIES] + [(6, '{"image":', "p"), (7, None, "p"), (8, "", "p"), (9, '{"image": NaN}', "p")]
    return spark.createDataFrame(rows, "record_id long, body string, image string")


def test_annotation_rows(spark):
    rows = op.annotation_rows(frame(spark), "record_id", "body").where("box_no >= 0").select("record_id", "page_pos", "image", "box_no", "label_no", "rectanglelabel", "x_milli")
    assert sorted(map(tuple, rows.collect())) == sorted([
        (1, 0, "p1", 0, 0, "a", 1500), (1, 0, "p1", 0, 1, "b", 1500), (1, 0, "p1", 1, 0, "c", 2000), (1, 0, "p1", 2, -1, "", -1),
        (2, 0, "", 0, -1, "", 0), (2, 1, "", 0, -1, "", -1),
        (3, 0, "d", 0, 0, "q", 3000), (3, 0, "d", 1, -1, "", -1),
    ])
    assert op.annotation_rows(frame(spark), "record_id", "body").where("box_no < 0").count() == 5


def test_flatten_keeps_links(spark):
    rows = op.flatten(frame(spark), "record_id", "body", op.LISTS, ("label",)).collect()
    keys = {(r.record_id, r.table_path, tuple(r.ordinals)) for r in rows}
    assert len(keys) == len(rows)
    assert all(r.table_path == "" or (r.record_id, r.parent_path, tuple(r.parent_ordinals)) in keys for r in rows if r.record_id != 2 or r.parent_path)
    labels = {(r.record_id, tuple(r.ordinals)): r.fields[""] for r in rows if r.table_path == "label[].rectanglelabels[]" and r.fields}
    assert labels == {(1, (0, 0)): "a", (1, (0, 2)): "b", (1, (2, 0)): "c"}


def test_round_trip_of_triples():
    value = {"a": [{"b": [1, 2, [3]]}, {"b": []}], "c": {"d": None, "e": "x"}}
    assert [t for t in op.triples(value) if t[2] is not None] == [("a[].b[]", (0, 0), 1), ("a[].b[]", (0, 1), 2), ("a[].b[][]", (0, 2, 0), 3), ("c.e", (), "x")]
    deep = "[" * 100_000 + "]" * 100_000
    assert op._load(deep) is None


def test_tables(spark):
    """A table for each repeated path, with the ordinals of its parents and typed columns."""
    bodies = ['[{"a":"x","b":[{"v":1,"w":"2","t":["p","q"]},null,{"v":2.5,"w":"z"}]},{"a":"y","b":[]}]', '{"a":{"c":true}}', "{bad", None]
    df = spark.createDataFrame(list(enumerate(bodies)), "record_id long, body string")
    flat = op.flatten(df, "record_id", "body")
    got = op.tables(flat)
    assert set(got) == {"", "[]", "[].b[]", "[].b[].t[]"}
    assert dict(got["[].b[]"].dtypes) == {"record_id": "bigint", "n0": "bigint", "n1": "bigint", "v": "double", "w": "string"}
    assert sorted(map(tuple, got["[].b[]"].collect())) == [(0, 0, 0, 1.0, "2"), (0, 0, 2, 2.5, "z")]
    assert sorted(map(tuple, got["[].b[].t[]"].collect())) == [(0, 0, 0, 0, "p"), (0, 0, 0, 1, "q")]
    joined = got["[].b[].t[]"].join(got["[].b[]"], ["record_id", "n0", "n1"]).join(got["[]"], ["record_id", "n0"])
    assert joined.where("a = 'x' AND v = 1").count() == 2 and [r.a__c for r in got[""].collect()] == ["true"]
    assert op.tables(flat.limit(0)) == {}
