"""Problem 5: splits of the training records by subject and group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import subject_key
from ..session import cut, table
from . import splits as op

SHARES = {"train": 0.8, "val": 0.1, "test": 0.1}


def _members(training: DataFrame) -> DataFrame:
    subject, group = F.substring_index("unique_id", "_", 1), F.regexp_extract("unique_id", r"^[^_]*_(.*)$", 1)
    named = [("s", subject), ("s", F.col("subject_id")), ("g", group), ("g", F.col("group_id"))]
    return op.connected(training, "row_id", [F.concat(F.lit(k), subject_key(c)) for k, c in named])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    training = table(spark, d, "training")
    members = cut(_members(training))
    return op.divided_sets(members, training, "row_id", op.split_name(F.col("split"))).select(F.col("record_id").alias("row_id"), "set_id")


def p5_splits(spark: SparkSession, d: str) -> DataFrame:
    training = table(spark, d, "training")
    members = cut(_members(training))
    label = training.select(F.col("row_id").alias("record_id"), F.col("case_control").alias("label"))
    given = op.assign_splits(members, label, SHARES)
    return members.join(given, "set_id").select(F.col("record_id").alias("row_id"), "set_id", "split")


def p5_balance(spark: SparkSession, d: str) -> DataFrame:
    """Records and cases of each split, and their shares."""
    cases = table(spark, d, "training").groupBy("row_id").agg(F.max("case_control").alias("case_control"))
    per = p5_splits(spark, d).join(cases, "row_id").groupBy("split").agg(F.count("*").alias("n_records"), F.count_if(F.col("case_control") == 1).alias("n_cases"), F.count_distinct("set_id").alias("n_sets"))
    totals = per.agg(F.sum("n_records").alias("a"), F.sum("n_cases").alias("c"))
    return per.crossJoin(F.broadcast(totals)).select("split", "n_records", "n_cases", "n_sets", (F.col("n_records") / F.col("a")).alias("share"), (F.col("n_cases") / F.col("c")).alias("case_share"))


QUERIES = {"p5_found": p5_found, "p5_splits": p5_splits, "p5_balance": p5_balance}

_SUBJECT = r"nullif(regexp_extract(regexp_replace({}, '[\s\x{{00A0}}\x{{FEFF}}]+', '', 'g'), '^0*([0-9]+)(?:[.,]0*)?$', 1), '')"
_KEYS = {"s": ("split_part(unique_id, '_', 1)", "subject_id"), "g": ("regexp_extract(unique_id, '^[^_]*_(.*)$', 1)", "group_id")}
_KEYED = " UNION ".join(f"SELECT row_id, '{k}' || {_SUBJECT.format(c)} AS k FROM training WHERE {_SUBJECT.format(c)} IS NOT NULL" for k, cs in _KEYS.items() for c in cs)
SQL = {
    "p5_found": f"""
WITH RECURSIVE keys AS MATERIALIZED ({_KEYED}), ks AS MATERIALIZED (SELECT DISTINCT a.k AS a, b.k AS b FROM keys a JOIN keys b USING (row_id)),
reach AS (SELECT DISTINCT k AS root, k FROM keys UNION SELECT r.root, ks.b FROM reach r JOIN ks ON ks.a = r.k),
sets AS (SELECT root, min(row_id) AS set_id FROM reach JOIN keys USING (k) GROUP BY 1), m AS (SELECT row_id, min(set_id) AS set_id FROM keys JOIN sets ON root = k GROUP BY 1),
n AS (SELECT row_id, CASE WHEN s IN ('train', 'training') THEN 'train' WHEN s IN ('val', 'validation', 'valid') THEN 'val' WHEN s IN ('test', 'testing') THEN 'test' END AS s FROM (SELECT row_id, regexp_replace(lower(split), '[\\s_\\-.]+', '', 'g') AS s FROM training)),
d AS (SELECT set_id FROM m JOIN n USING (row_id) GROUP BY 1 HAVING count(DISTINCT s) > 1) SELECT row_id, set_id FROM m WHERE set_id IN (SELECT set_id FROM d)""",
}
