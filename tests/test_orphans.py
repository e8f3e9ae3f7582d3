"""References without a record alive at their time, against brute force."""

import random
from datetime import datetime, timedelta

from foliant.operators import orphans as op
from pyspark.sql import functions as F

T0 = datetime(2021, 1, 1)
KIND = "row_id long, key string, at timestamp_ntz, table_name string, extra int"
TARGET = "id string, b timestamp_ntz, e timestamp_ntz, key string"


def run(spark, refs, targets):
    r = spark.createDataFrame(refs, "row_id long, raw string, at timestamp_ntz, table_name string, kind int")
    t = spark.createDataFrame(targets, TARGET)
    a = op.references(r, "runs", "row_id", "raw", F.nullif(F.col("raw"), F.lit("?")), "at")
    b = op.targets(t, "runs", F.nullif(F.col("id"), F.lit("?")), "b", "e")
    return sorted((x.row_id, x.ref_month, x.kind) for x in op.orphan_references(a, b).collect())


def brute(refs, targets):
    out = []
    for row, raw, at, *_ in refs:
        if raw is None:
            continue
        own = [(b or datetime.min, e) for i, b, e, _ in targets if i == raw and raw != "?"]
        month = at.strftime("%Y-%m") if at else None
        if not own:
            out.append((row, month, "missing"))
        elif at is not None:
            begun = [(b, e) for b, e in own if b <= at]
            if not begun:
                out.append((row, month, "late"))
            elif all(e is not None and e <= at for _, e in begun):
                out.append((row, month, "deleted"))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rng = random.Random(5)
    when = lambda: T0 + timedelta(hours=rng.randrange(0, 24 * 12))
    keys = ["a"] * 6 + list("bcdefgh") + ["?", None]
    refs = [(k, rng.choice(keys), None if rng.random() < 0.05 else when(), "x", 1) for k in range(400)]
    refs += refs[:20]
    targets = []
    for _ in range(60):
        b = when()
        targets.append((rng.choice(["a", "b", "c", "d", "?", None]), None if rng.random() < 0.05 else b, None if rng.random() < 0.2 else b + timedelta(hours=rng.randrange(-3, 60)), "y"))
    assert sorted(run(spark, refs, targets), key=str) == brute(refs, targets)
    gone = [t for t in targets if t[2] is not None]
    assert sorted(run(spark, refs, gone), key=str) == brute(refs, gone)


def test_ends_count_as_gone(spark):
    t = [("a", T0, T0 + timedelta(1), None), ("a", T0 + timedelta(1), T0 + timedelta(2), None)]
    refs = [(1, "a", T0, "x", 1), (2, "a", T0 + timedelta(1), "x", 1), (3, "a", T0 + timedelta(2), "x", 1), (4, "a", T0 - timedelta(1), "x", 1)]
    assert run(spark, refs, t) == [(3, "2021-01", "deleted"), (4, "2020-12", "late")]


def test_empty(spark):
    assert run(spark, [], []) == []
    assert run(spark, [(1, "a", T0, "x", 1)], []) == [(1, "2021-01", "missing")]
    assert run(spark, [], [("a", T0, None, None)]) == []
