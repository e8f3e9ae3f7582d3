"""Problem 7: evaluation items in the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from .leakage import leaked_items


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaked_items(table(spark, d, "documents"), table(spark, d, "eval_item"))


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """Leaked items with their documents' number and sources."""
    sources = table(spark, d, "documents").select("doc_id", "source")
    return p7_found(spark, d).join(sources, "doc_id").groupBy("item_id").agg(F.count("*").alias("n_documents"), F.count_distinct("source").alias("n_sources"))


QUERIES = {"p7_found": p7_found, "p7_items": p7_items}
SQL: dict[str, str] = {}
