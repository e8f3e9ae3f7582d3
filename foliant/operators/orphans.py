"""References to records that do not exist, or did not exist at the time of the reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVER = "0001-01-01 00:00:00"


def references(df: DataFrame, table_name: str, row_id: str, raw_key: str, key: Column, at: str) -> DataFrame:
    """References of one table in common columns; rows whose raw key is null refer to nothing."""
    return df.where(F.col(raw_key).isNotNull()).select(
        F.lit(table_name).alias("table_name"), F.col(row_id).cast("long").alias("row_id"), key.alias("key"), F.col(at).cast("timestamp_ntz").alias("at")
    )


def targets(df: DataFrame, table_name: str, key: Column, begins: str, ends: str) -> DataFrame:
    """Records that `table_name` refers to. A record without a begin has always existed, one without an end still does."""
    begin = F.coalesce(F.col(begins).cast("timestamp_ntz"), F.lit(EVER).cast("timestamp_ntz"))
    return df.select(F.lit(table_name).alias("table_name"), key.alias("key"), begin.alias("begins"), F.col(ends).cast("timestamp_ntz").alias("ends")).where(F.col("key").isNotNull())


def orphan_references(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """Every reference without a record alive at its time: `table_name, row_id, ref_month, kind`.

    The distinct foreign keys are held against one row per parent key and joined back to the references; as the join back
    is a left join from the references, adaptive execution may split a hot key's partition. `missing`: no record at all,
    or a key that can't be read. `late`: all records begin after the reference. `deleted`: some began, and all of those
    were gone. Only references before the first record that is never removed need a timeline. That is a prefix sum of
    begins and ends in two levels, within a day and over days, so that no task holds all events of a hot key.

    Repeated references each give a row. References without a time are held against `missing` only and have no month.
    Records that end no later than they begin never existed but count as begun. Empty tables give no rows.
    """
    by = ["table_name", "key"]
    day = lambda c: F.to_date(c)
    closed = parents.where(F.col("ends") > F.col("begins"))
    moves = closed.select(*by, F.explode(F.array(F.struct(F.col("begins").alias("at"), F.lit(1).alias("step")), F.struct(F.col("ends").alias("at"), F.lit(-1).alias("step")))).alias("m"))
    moves = moves.groupBy(*by, F.col("m.at").alias("at")).agg(F.sum("m.step").alias("step"))
    days = moves.groupBy(*by, day("at").alias("day")).agg(F.sum("step").alias("step"))
    upto = days.select(*by, "day", F.sum("step").over(Window.partitionBy(*by).orderBy("day")).alias("upto"))
    spans = upto.groupBy(*by).agg(F.collect_list(F.struct("day", "upto")).alias("spans"))  # at most one for each day of the calendar
    parent = parents.groupBy(*by).agg(F.min("begins").alias("first"), F.min(F.when(F.col("ends").isNull(), F.col("begins"))).alias("lasting")).join(spans, by, "left")

    readable = refs.where(F.col("key").isNotNull())
    absent = readable.select(*by).distinct().join(parent, by, "left_anti").withColumn("absent", F.lit(True))
    keys = parent.withColumn("absent", F.lit(False)).unionByName(absent, allowMissingColumns=True)
    month = F.substring(F.col("at").cast("string"), 1, 7)
    named = refs.join(keys, by, "left").withColumn("kind", F.when(F.col("key").isNull() | F.col("absent"), "missing").when(F.col("first") > F.col("at"), "late"))
    open_ = (F.col("first") <= F.col("at")) & (F.col("lasting").isNull() | (F.col("lasting") > F.col("at")))
    before = F.array_max(F.filter("spans", lambda s: s["day"] < day("at")))["upto"]
    left = named.where(F.col("kind").isNotNull() | open_).select(*by, "at", "row_id", month.alias("ref_month"), "kind", before.alias("before"))
    # References that are judged already stand each by itself in the window below.
    left = left.withColumn("apart", F.when(F.col("kind").isNotNull(), F.col("row_id")))
    line = left.unionByName(moves, allowMissingColumns=True).withColumn("day", day("at"))
    inner = Window.partitionBy(*by, "day", "apart").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    alive = F.coalesce(F.sum("step").over(inner), F.lit(0)) + F.coalesce("before", F.lit(0))
    judged = line.withColumn("kind", F.coalesce("kind", F.when(alive <= 0, "deleted")))
    return judged.where("row_id IS NOT NULL AND kind IS NOT NULL").select("table_name", "row_id", "ref_month", "kind")


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans per table, month and kind."""
    return orphans.groupBy("table_name", "ref_month", "kind").agg(F.count("*").alias("n_orphans"))
