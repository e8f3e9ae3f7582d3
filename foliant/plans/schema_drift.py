"""Problem 1: successive annotation files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import schema_drift as op
from ..session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return op.changes(table(spark, d, "doc_5_export"))


def p1_unified(spark: SparkSession, d: str) -> DataFrame:
    """All records in one table of typed columns."""
    return op.unified(table(spark, d, "doc_5_export"))[0]


QUERIES = {"p1_found": p1_found, "p1_unified": p1_unified}
SQL: dict[str, str] = {}
