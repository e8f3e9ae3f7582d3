"""Sets of ids held against each other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def presence(sources: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """One row per key with a flag for each source that has it. Null keys are left out."""
    tagged = reduce(DataFrame.unionByName, (df.select(key.alias("key"), F.lit(name).alias("source")) for name, (df, key) in sources.items()))
    flags = [F.max(F.when(F.col("source") == name, 1).otherwise(0)).alias(name) for name in sources]
    return tagged.where("key IS NOT NULL").groupBy("key").agg(*flags)


def differences(held: DataFrame, sources: list[str]) -> DataFrame:
    """For each ordered pair of sources: keys of each, of both, of the first only, and the least of those."""
    pairs = [(a, b) for a in sources for b in sources if a != b]
    cells = [F.struct(F.lit(a).alias("left_source"), F.lit(b).alias("right_source"), F.col(a).alias("l"), F.col(b).alias("r")) for a, b in pairs]
    rows = held.select("key", F.inline(F.array(*cells)))
    only = (F.col("l") == 1) & (F.col("r") == 0)
    return rows.groupBy("left_source", "right_source").agg(
        F.sum("l").cast("long").alias("n_left"),
        F.sum("r").cast("long").alias("n_right"),
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("n_both"),
        F.count_if(only).alias("n_only_left"),
        F.min(F.when(only, F.col("key"))).alias("example"),
    )


def missing_by_wave(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Per wave: keys expected, found, expected only and found only, from frames of `key, q`."""
    both = expected.select("key", "q", F.lit(1).alias("e"), F.lit(0).alias("f")).unionByName(found.select("key", "q", F.lit(0).alias("e"), F.lit(1).alias("f")))
    flags = both.where("key IS NOT NULL AND q IS NOT NULL").groupBy("key", "q").agg(F.max("e").alias("e"), F.max("f").alias("f"))
    return flags.groupBy("q").agg(
        F.sum("e").cast("long").alias("n_expected"),
        F.sum("f").cast("long").alias("n_found"),
        F.count_if((F.col("e") == 1) & (F.col("f") == 0)).alias("n_missing"),
        F.count_if((F.col("e") == 0) & (F.col("f") == 1)).alias("n_unexpected"),
    )


def missing_flags(expected: DataFrame, found: DataFrame, waves: int = 13) -> DataFrame:
    """One row per key that lacks any expected wave, with a flag per wave."""
    gone = expected.select("key", "q").distinct().join(found.select("key", "q").distinct(), ["key", "q"], "left_anti")
    flags = [F.max(F.when(F.col("q") == q, 1).otherwise(0)).alias(f"q{q}_missing") for q in range(1, waves + 1)]
    return gone.where("key IS NOT NULL AND q IS NOT NULL").groupBy("key").agg(*flags)


def append_new(ledger: DataFrame, key: Column, found: DataFrame, found_key: Column) -> DataFrame:
    """Keys found and not yet in a ledger, as new entries `id, processed`."""
    new = found.select(found_key.alias("id")).where("id IS NOT NULL").distinct()
    return new.join(ledger.select(key.alias("id")).where("id IS NOT NULL").distinct(), "id", "left_anti").withColumn("processed", F.lit(False))


def transfer(files: DataFrame, ledger: DataFrame, by: list[str], cap: int = 0, per: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Files of the keys not yet in a ledger, and the ledger with these keys: all of them, or the first `cap`, of each `per` (such as the wave) if given."""
    new = files.select(*by).dropna().distinct().join(ledger.select(*by), by, "left_anti")
    if cap > 0 and per:
        place = F.row_number().over(Window.partitionBy(*per).orderBy(*by))
        new = new.withColumn("_place", place).where(F.col("_place") <= cap).drop("_place")
    elif cap > 0:
        new = new.orderBy(*by).limit(cap)
    return files.join(new, by, "left_semi"), ledger.select(*by).unionByName(new)


def name_mismatches(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """`name, missing_in` of names that one side lacks; no rows if all match."""
    a = left.select(F.col(name).alias("name")).distinct().withColumn("l", F.lit(1))
    b = right.select(F.col(name).alias("name")).distinct().withColumn("r", F.lit(1))
    both = a.join(b, "name", "full").where("l IS NULL OR r IS NULL")
    return both.select("name", F.when(F.col("l").isNull(), "left").otherwise("right").alias("missing_in"))
