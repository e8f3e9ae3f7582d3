"""Changes between files, and one table of them."""

import itertools
import json
import random
from datetime import datetime, timedelta

import numpy as np
from foliant.functions.assignment import assign
from foliant.operators import schema_drift as op

KIND = "file_no long, stream string, exported_at timestamp_ntz, record_no long, record string, path string"


def rows_of(files):
    rows = []
    for no, (stream, at, records) in files.items():
        rows += [(no, stream, datetime(2021, 1, 1) + timedelta(days=at), k, json.dumps(r) if isinstance(r, dict) else r, "p") for k, r in enumerate(records)]
    return rows


def make(rng, shade="shade", mass="mass", texts=False, box=True, extra=None):
    r = {"id": rng.randrange(10**6), shade: rng.choice(["red", "blue"]), "label": [{"x": round(rng.random() * 90, 3), "tag": ["t"]} if box else {"tag": "t"}], mass: str(rng.randrange(50, 90)) if texts else rng.randrange(50, 90)}
    return r | (extra or {})


def test_changes(spark):
    rng = random.Random(1)
    many = lambda **k: [make(rng, **k) for _ in range(12)]
    files = {
        1: ("s", 1, many()),
        2: ("s", 2, many(shade="hue_name", extra={"note": "x"})),
        3: ("s", 3, [*many(shade="hue_name", texts=True, box=False), None, "{broken", '{"note": null}']),
        4: (None, 1, many(mass="mass_kg")),
        5: (None, 1, many(mass="mass_kg")),
        6: ("t", 1, [None]),
        7: ("t", 2, many(extra={"flag": True})),
    }
    df = spark.createDataFrame(rows_of(files) * 2, KIND)
    got = sorted(map(tuple, op.changes(df).collect()))
    assert got == sorted([
        (2, "hue_name", "renamed", "shade"), (2, "note", "added", ""),
        (3, "note", "removed", ""), (3, "label.x", "removed", ""), (3, "label.tag", "retyped", ""), (3, "mass", "retyped", ""),
        *((7, p, "added", "") for p in ("id", "shade", "label", "label.x", "label.tag", "mass", "flag")),
    ])
    assert op.changes(df.limit(0)).collect() == []


def test_unified(spark):
    """One typed column a field: numbers as texts are numbers, single values are lists where others are; names stay within a stream."""
    rng = random.Random(1)
    many = lambda **k: [make(rng, **k) for _ in range(12)]
    files = {
        1: ("s", 1, many()), 2: ("s", 2, [*many(shade="hue_name", extra={"note": "x", "sure": True}), None, "{bad"]),
        3: ("s", 3, [*many(shade="hue_name", texts=True, box=False, extra={"note": ["y", 1], "deep": {"a": 1}}), {"shade": "a", "hue_name": "b"}]), 4: (None, 1, many(mass="mass_kg")), 5: (None, 2, many()), 6: ("z", 1, many(shade="hue_name", extra={"sure": False})),
    }
    df = spark.createDataFrame(rows_of(files), KIND)
    out, report = op.unified(df)
    assert dict(out.dtypes) == {
        "file_no": "bigint", "record_no": "bigint", "id": "double", "shade": "string", "hue_name": "string", "label__x": "array<double>", "label__tag": "array<array<string>>",
        "mass": "double", "note": "array<string>", "sure": "boolean", "deep": "string", "other": "map<string,string>",
    }
    rows = {(r.file_no, r.record_no): r for r in out.collect()}
    assert len(rows) == sum(len(f[2]) for f in files.values())
    assert all(rows[f, 0].shade and not rows[f, 0].hue_name for f in (1, 2, 3, 4, 5)) and rows[6, 0].hue_name and not rows[6, 0].shade
    assert rows[3, 12].shade == "a" and rows[3, 12].other == {"hue_name": '"b"'} and rows[2, 12].id is None and rows[2, 13].other is None
    assert rows[2, 0].note == ["x"] and rows[3, 0].note == ["y", "1"] and rows[3, 0].mass in range(50, 90) and rows[3, 0].deep == '{"a": 1}' and rows[3, 0].label__tag == [["t"]] and rows[1, 0].label__x[0] < 90 and rows[4, 0].mass
    assert report.where("change_kind = 'renamed' AND file_no = 2").count() == 1
    empty, none = op.unified(df.limit(0))
    assert empty.collect() == [] and none.collect() == []


def test_hot_file_and_order(spark):
    """A file with most of the records is spread and merged; months and ties order a stream's files."""
    rng = random.Random(2)
    files = {1: ("s", 0, [make(rng, extra={"rare": k} if k == 7 else None) for k in range(5000)]), 2: ("s", 40, [make(rng)]), 4: ("s", 40, [make(rng)]), 3: ("s", 40, [make(rng, extra={"note": "x"})]), 5: ("s", 100, [make(rng)])}
    df = spark.createDataFrame(rows_of(files), KIND)
    assert {r.file_no: r.before for r in op.before(op.files_of(df)).collect()} == {1: None, 2: 1, 3: 2, 4: 3, 5: 4}
    assert sorted(map(tuple, op.changes(df).collect())) == [(2, "rare", "removed", ""), (3, "note", "added", ""), (4, "note", "removed", "")]


def test_values_count_whole():
    long = ["a" * 80 + str(k) for k in range(5)]
    assert len({t for v in long for t in op.leaves(v)}) == 5 and op.value_similarity(list(op.leaves(long)), list(op.leaves(["a" * 80 + "x"]))) == 0


def test_assignment_is_optimal():
    rng = np.random.default_rng(1)
    for n, m in [(1, 1), (3, 3), (4, 3), (3, 5), (6, 6)]:
        for _ in range(30):
            cost = rng.integers(-5, 9, (n, m)).astype(float)
            got = assign(cost)
            assert len(got) == min(n, m) and len({c for _, c in got}) == len(got) == len({r for r, _ in got})
            small, flip = (cost, False) if n <= m else (cost.T, True)
            best = min(sum(small[i, p[i]] for i in range(small.shape[0])) for p in itertools.permutations(range(small.shape[1]), small.shape[0]))
            assert sum(cost[r, c] for r, c in got) == best
    assert assign(np.zeros((0, 3))) == []


def test_similarities():
    assert op.name_similarity("img_type", "imageType") > 0.85 and op.name_similarity("leadTime", "lead_time") == 1
    assert op.value_similarity(["C", "N"], ["N"]) == 1 and op.value_similarity(["C"], ["1"]) == 0 and op.value_similarity([], ["1"]) == 0
