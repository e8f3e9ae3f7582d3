"""Connected sets, and splits of them, against union and find."""

import random

import pytest
from foliant.llm import splits as op
from foliant.operators import skew
from pyspark.sql import functions as F

KIND = "row_id long, a string, b string, split string, label int, set_id int"


def brute(rows):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for r in rows:
        for k, v in (("a", r[1]), ("b", r[2])):
            if v is not None:
                root[find((k, v))] = find(("r", r[0]))
    least = {}
    for r in rows:
        least[find(("r", r[0]))] = min(r[0], least.get(find(("r", r[0])), r[0]))
    return {r[0]: least[find(("r", r[0]))] for r in rows}


def members(spark, rows):
    df = spark.createDataFrame(rows, KIND)
    return df, op.connected(df, "row_id", [F.concat(F.lit("a"), "a"), F.concat(F.lit("b"), "b")])


@pytest.mark.parametrize("hot", [False, True])
def test_connected(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(op, "hot_keys", lambda df, by: df.groupBy(*by).count().where("count > 3").select(*by, F.lit(True).alias("_hot")))
        divided = op.divided
        monkeypatch.setattr(op, "divided", lambda links: divided(links, 1e-9, 3))
    rng = random.Random(4)
    pick = lambda p, n: None if rng.random() < 0.2 else f"{p}{rng.randrange(n) if rng.random() < 0.8 else 0}"
    rows = [(k, pick("x", 90), pick("y", 70), rng.choice(["Train ", "validation", "VAL", "test", None, "?"]), rng.choice([0, 1, None]), 1) for k in range(100, 260)]
    rows += [(1000 - k, f"c{k}", f"c{k + 1}" if k % 2 else f"c{k}", None, 0, 1) for k in range(60)]  # a chain: c0-c0, c1-c2, c2-c2, ...
    rows += rows[:9] + [(5000, None, None, "train", 1, 1)]
    df, m = members(spark, rows)
    want = brute(rows)
    assert dict(map(tuple, m.collect())) == want
    given = {}
    for r in rows:
        name = {"Train ": "train", "validation": "val", "VAL": "val", "test": "test"}.get(r[3])
        given.setdefault(want[r[0]], set()).update({name} - {None})
    divided = sorted((i, s) for i, s in want.items() if len(given[s]) > 1)
    assert sorted(map(tuple, op.divided_sets(m, df, "row_id", op.split_name(F.col("split"))).collect())) == divided


def test_long_chain(spark):
    n = 300
    order = random.Random(1).sample(range(n), n)
    rows = [(order[k], f"n{k}", None, None, 0, 1) for k in range(n)]
    rows = [(order[k], f"{k // 2}", f"{(k + 1) // 2}", None, 0, 1) for k in range(n)]
    _, m = members(spark, rows)
    assert {r.set_id for r in m.collect()} == {0}


def test_assignment(spark):
    rng = random.Random(2)
    sizes = [900] + [rng.choice([1, 1, 2, 3, 8]) for _ in range(2000)]
    rows, k = [], 0
    for s, n in enumerate(sizes):
        for _ in range(n):
            rows.append((k, s * 10**6, rng.choice([0, 0, 0, 1, None])))
            k += 1
    df = spark.createDataFrame(rows, "record_id long, set_id long, label int")
    got = op.assign_splits(df.select("record_id", "set_id"), df.select("record_id", "label"), {"train": 0.8, "val": 0.1, "test": 0.1})
    per = {r.set_id: r.split for r in got.collect()}
    assert len(per) == len(sizes)
    for label in (None, 0, 1):
        chosen = [r for r in rows if label is None or r[2] == label]
        for split, share in (("train", 0.8), ("val", 0.1), ("test", 0.1)):
            assert abs(sum(per[r[1]] == split for r in chosen) / len(chosen) - share) < 0.025
    assert op.assign_splits(df.limit(0).select("record_id", "set_id"), df.select("record_id", "label"), {"train": 1.0}).collect() == []


SHARES = {"train": 0.8, "val": 0.1, "test": 0.1}


def shares_of(spark, sets, **kw):
    """Share of the records, and of each label's, that each split gets of sets given as lists of labels."""
    rows = [(k * 10**4 + i, k, v) for k, own in enumerate(sets) for i, v in enumerate(own)]
    df = spark.createDataFrame(rows, "record_id long, set_id long, label int")
    per = {r.set_id: r.split for r in op.assign_splits(df.select("record_id", "set_id"), df.select("record_id", "label"), SHARES, **kw).collect()}
    assert set(per) == set(range(len(sets)))
    return {v: {s: sum(per[r[1]] == s for r in rows if v in ("all", r[2])) / sum(v in ("all", r[2]) for r in rows) for s in SHARES} for v in ("all", *{r[2] for r in rows})}


def test_labels_of_a_giant_are_made_up(spark):
    rng = random.Random(5)
    rest = [[int(rng.random() < 0.3) for _ in range(rng.choice([1, 1, 2, 3]))] for _ in range(2000)]
    got = shares_of(spark, [[0] * (sum(map(len, rest)) // 2), *rest])
    for label in ("all", 0, 1):
        assert all(abs(got[label][s] - share) < 0.01 for s, share in SHARES.items()), got


def test_few_sets_of_a_kind_reach_all_splits(spark):
    got = shares_of(spark, [[k] * 5 for k in range(40) for _ in range(2)], big=50)["all"]
    assert all(abs(got[s] - share) < 0.03 for s, share in SHARES.items()), got


def test_divided_entities(spark):
    """A hot entity becomes many small ones that still connect all that it did."""
    links = spark.range(1000).select(F.col("id").alias("label"), F.when(F.col("id") < 600, "hot").otherwise(F.concat(F.lit("e"), F.col("id").cast("string"))).alias("entity"))
    out = op.divided(links, 0.01, 1)
    assert out.groupBy("entity").count().agg(F.max("count")).first()[0] < 61
    hot = out.where("entity LIKE 'hot%'")
    assert hot.where("entity <> 'hot'").count() == 600 and hot.where("entity = 'hot'").count() == hot.where("entity <> 'hot'").select("entity").distinct().count() == 60
    ids = spark.range(5000).select(op._mixed(F.col("id") - 2500).alias("m"))
    assert ids.distinct().count() == 5000


def test_too_many_labels(spark):
    df = spark.range(20).select(F.col("id").alias("record_id"), F.col("id").alias("set_id"), F.col("id").alias("label"))
    with pytest.raises(ValueError):
        op.assign_splits(df.select("record_id", "set_id"), df.select("record_id", "label"), SHARES, most_labels=19)


def test_empty(spark):
    _, m = members(spark, [])
    assert m.collect() == []


def test_hot_keys_are_few(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    assert [r.k for r in skew.hot_keys(df, ["k"]).collect()] == [0]
    hot = skew.hot_keys(df, ["k"])
    wide = skew.salted(df, ["k"], hot, F.col("id"), 8).join(skew.replicated(df.groupBy("k").count(), ["k"], hot, 8), ["k", "_salt"])
    assert wide.count() == 20_000 and wide.where("k = 0").select("_salt").distinct().count() == 8
