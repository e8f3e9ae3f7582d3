"""Joins on keys of which a few may hold a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, by: Sequence[str], share: float = 1 / 256) -> DataFrame:
    """Keys that hold more than a share of the rows: fewer than 1 / share rows, whatever the data."""
    counts = df.groupBy(*by).agg(F.count("*").alias("_n"))
    return counts.where(F.col("_n") > max(1000, df.count() * share)).select(*by, F.lit(True).alias("_hot"))


def salted(df: DataFrame, by: Sequence[str], hot: DataFrame, spread: Column, salts: int = 64) -> DataFrame:
    """Rows with `_salt`: 0, or for hot keys one of `salts` numbers."""
    return df.join(F.broadcast(hot), list(by), "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(F.lit(0).cast("long"))).drop("_hot")


def replicated(df: DataFrame, by: Sequence[str], hot: DataFrame, salts: int = 64) -> DataFrame:
    """Rows of one per key, with hot ones once for each salt: at most salts / share more rows."""
    each = F.expr(f"explode(if(_hot, sequence(0L, {salts - 1}L), array(0L)))")
    return df.join(F.broadcast(hot), list(by), "left").select(*df.columns, each.alias("_salt"))


def numbered(df: DataFrame, key: str, number: str, prefix: int = 3) -> DataFrame:
    """Rows of distinct text keys with their position in the keys' order, from 1.

    Texts order as their prefixes do, so the position is a count within a prefix and a sum over the prefixes before: no task
    orders all keys.
    """
    rows = df.withColumn("_p", F.substring(F.col(key), 1, prefix))
    parts = rows.groupBy("_p").agg(F.count("*").alias("_c"))
    parts = parts.select("_p", (F.sum("_c").over(Window.orderBy("_p")) - F.col("_c")).alias("_base"))
    position = F.col("_base") + F.row_number().over(Window.partitionBy("_p").orderBy(key))
    return rows.join(parts, "_p").withColumn(number, position.cast("long")).drop("_p", "_base")
