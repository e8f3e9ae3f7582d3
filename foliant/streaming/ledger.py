"""The one incremental need of the pipeline: success files that arrive over time, held against a ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.keys import subject_key


def follow(runs: DataFrame, ledger_path: str, checkpoint: str, id_col: str = "e3n_id_hand") -> StreamingQuery:
    """Appends ids not yet in the ledger, batch by batch; a batch that is run again adds nothing twice.

    Batches are anti-joined with the ledger as written. The query ends when all files there at its start are done.
    """

    def add(batch: DataFrame, _: int) -> None:
        spark: SparkSession = batch.sparkSession
        new = batch.select(subject_key(F.col(id_col)).alias("id")).where("id IS NOT NULL").distinct()
        try:
            new = new.join(spark.read.parquet(ledger_path).select("id"), "id", "left_anti")
        except Exception as e:  # no ledger yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        new.withColumn("processed", F.lit(False)).write.mode("append").parquet(ledger_path)

    return runs.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(runs: DataFrame, at: str = "logged_at", late: str = "30 days", width: str = "1 day") -> DataFrame:
    """Runs per wave and day of a stream, each closed once its rows can be no later."""
    return runs.withWatermark(at, late).groupBy(F.window(at, width), "q").agg(F.count("*").alias("n")).select(F.col("window.start").alias("day"), "q", "n")
