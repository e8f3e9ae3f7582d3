"""Problem 6: documents in containers of 2,048 tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, table
from . import packing as op

CAPACITY = 2048


def p6_packing(spark: SparkSession, d: str) -> DataFrame:
    return op.pack(cut(op.token_counts(table(spark, d, "documents"), "doc_id", "text")), CAPACITY)


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens, the part of the containers' room that is used, and the least containers that could do."""
    bins = p6_packing(spark, d).groupBy("container_id").agg(F.sum("n_tokens").alias("n"))
    return bins.agg(F.count("*").alias("n_containers"), F.sum("n").alias("n_tokens"), F.max("n").alias("fullest"), (F.sum("n") / (F.count("*") * CAPACITY)).alias("used"), F.ceil(F.sum("n") / CAPACITY).alias("least_containers"))


QUERIES = {"p6_packing": p6_packing, "p6_fill": p6_fill}
SQL: dict[str, str] = {}
