"""Logs of runs, and the accuracy of what they found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_per_id(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Each id's last row, with all its columns."""
    others = [c for c in df.columns if c != key]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_r")).select(key, "_r.*")


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """`column_name, value, n` of the columns' values, nulls left out."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*cells))).where("value IS NOT NULL").groupBy("column_name", "value").agg(F.count("*").alias("n"))


def longest(df: DataFrame, key: str, time: str, k: int = 5) -> DataFrame:
    return df.where(F.col(time).isNotNull()).select(key, time).orderBy(F.desc(time), key).limit(k)


def time_stats(df: DataFrame, time: str, above: float = 100) -> DataFrame:
    return df.agg(F.count(time).alias("n"), F.avg(time).alias("mean_time"), F.max(time).alias("most_time"), F.count_if(F.col(time) > above).alias("n_above"))


def accuracy(a: Column, b: Column) -> Column:
    """Share of rows with equal values; a null equals nothing."""
    return F.avg(F.coalesce((a == b).cast("int"), F.lit(0)))


def mode_accuracy(df: DataFrame, group: str, found: str, true: str) -> DataFrame:
    """One row: groups, and the share whose most frequent found value, the least of ties, is the true one; 0 without groups.

    Values are counted before they are ranked, so a hot group shuffles one row per distinct value.
    """
    cells = F.array(F.struct(F.lit("found").alias("side"), F.col(found).cast("string").alias("v")), F.struct(F.lit("true").alias("side"), F.col(true).cast("string").alias("v")))
    counts = df.where(F.col(group).isNotNull()).select(F.col(group).alias("g"), F.inline(cells)).groupBy("g", "side", "v").agg(F.count("*").alias("n"))
    best = counts.groupBy("g", "side").agg(F.min(F.when(F.col("v").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("v").alias("v")))).alias("b"))
    sides = best.groupBy("g").agg(F.max(F.when(F.col("side") == "found", F.col("b.v"))).alias("a"), F.max(F.when(F.col("side") == "true", F.col("b.v"))).alias("b"))
    return sides.agg(F.count("*").alias("n_groups"), F.coalesce(accuracy(F.col("a"), F.col("b")), F.lit(0.0)).alias("accuracy"))


def numbers_only(df: DataFrame, columns: list[str], without: str = "ISP") -> DataFrame:
    """Rows whose first column doesn't contain a text, with the columns as numbers; rows with one that isn't a number go."""
    rows = df.where(~F.coalesce(F.col(columns[0]).contains(without), F.lit(False)))
    return rows.withColumns({c: F.expr(f"try_cast(`{c}` AS double)") for c in columns}).dropna(subset=columns)
