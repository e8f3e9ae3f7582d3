"""Problem 4: orphans of the questionnaire tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import scan_key, subject_key
from ..operators import orphans as op
from ..session import table
from . import sql


def _inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    runs, progress, cohort, scans, manifest = (table(spark, d, t) for t in ("combined_success_ids", "progress", "covariates", "doc_5", "manifest"))
    refs = [
        op.references(runs, "combined_success_ids", "row_id", "e3n_id_hand", subject_key(F.col("e3n_id_hand")), "logged_at"),
        op.references(progress, "progress", "row_id", "id", subject_key(F.col("id")), "created_at"),
        op.references(scans, "doc_5", "record_id", "object_name", scan_key(F.col("object_name")), "exported_at"),
    ]
    parents = [
        op.targets(progress, "combined_success_ids", subject_key(F.col("id")), "created_at", "removed_at"),
        op.targets(cohort, "progress", subject_key(F.col("ident_projet")), "registered_at", "withdrawn_at"),
        op.targets(manifest, "doc_5", scan_key(F.col("object_name")), "received_at", "removed_at"),
    ]
    return reduce(DataFrame.unionByName, refs), reduce(DataFrame.unionByName, parents)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return op.orphan_references(*_inputs(spark, d))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return op.orphan_report(p4_found(spark, d))


_FOUND = f"""
WITH refs AS (
  SELECT 'combined_success_ids' AS table_name, row_id, {sql.subject('e3n_id_hand')} AS k, logged_at AS ts FROM combined_success_ids WHERE e3n_id_hand IS NOT NULL
  UNION ALL SELECT 'progress', row_id, {sql.subject('id')}, created_at FROM progress WHERE id IS NOT NULL
  UNION ALL SELECT 'doc_5', record_id, {sql.scan('object_name')}, exported_at FROM doc_5 WHERE object_name IS NOT NULL),
parents AS (
  SELECT 'combined_success_ids' AS table_name, {sql.subject('id')} AS k, created_at AS b, removed_at AS e FROM progress
  UNION ALL SELECT 'progress', {sql.subject('ident_projet')}, registered_at, withdrawn_at FROM covariates
  UNION ALL SELECT 'doc_5', {sql.scan('object_name')}, received_at, removed_at FROM manifest),
held AS (
  SELECT r.table_name, r.row_id, r.ts, count(p.k) AS n, count(*) FILTER (WHERE p.b <= r.ts) AS begun,
         count(*) FILTER (WHERE p.b <= r.ts AND (p.e IS NULL OR p.e > r.ts)) AS alive
  FROM refs r LEFT JOIN parents p ON p.table_name = r.table_name AND p.k = r.k GROUP BY ALL)
SELECT table_name, row_id, strftime(ts, '%Y-%m') AS ref_month,
       CASE WHEN n = 0 THEN 'missing' WHEN begun = 0 THEN 'late' ELSE 'deleted' END AS kind
FROM held WHERE n = 0 OR alive = 0"""

QUERIES = {"p4_found": p4_found, "p4_report": p4_report}
SQL = {
    "p4_found": _FOUND,
    "p4_report": f"SELECT table_name, ref_month, kind, count(*) AS n_orphans FROM ({_FOUND}) GROUP BY ALL",
}
