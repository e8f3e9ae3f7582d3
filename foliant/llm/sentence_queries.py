"""Problem 8: sentence units of the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import table
from .sentences import sentence_units


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return sentence_units(table(spark, d, "documents"))


QUERIES = {"p8_found": p8_found}
SQL: dict[str, str] = {}
