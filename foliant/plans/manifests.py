"""Manifest cleaning and audits, and sets of ids held against each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import scan_key, subject_key
from ..operators import manifest as op
from ..operators import reconcile
from ..session import table
from . import sql

NAME, SUBJECT = "object_name", "e3n_id_hand"


def _manifest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manifest")


def manifest_clean(spark, d):
    return op.clean(_manifest(spark, d), NAME, SUBJECT)


def manifest_audit(spark, d):
    return op.audit(_manifest(spark, d), NAME, SUBJECT)


def files_per_subject(spark, d):
    return op.files_per_subject(_manifest(spark, d), NAME, SUBJECT)


def conflicting_names(spark, d):
    return op.repeated_names(_manifest(spark, d), NAME, SUBJECT)


def name_length_distribution(spark, d):
    return op.name_lengths(_manifest(spark, d), NAME)


def underscore_distribution(spark, d):
    return op.underscores(_manifest(spark, d), NAME)


def shortest_names(spark, d):
    return op.shortest_names(_manifest(spark, d), NAME, "row_id")


def fewest_underscores(spark, d):
    return op.fewest_underscores(_manifest(spark, d), NAME, "row_id")


def last_subject_of_name(spark, d):
    return op.last_subject(_manifest(spark, d), NAME, SUBJECT, "row_id")


def unused_of_cohort(spark, d):
    """Unused manifest rows of cohort subjects."""
    cohort = table(spark, d, "covariates").select(subject_key(F.col("ident_projet")).alias("key"))
    rows = _manifest(spark, d).withColumn("key", subject_key(F.col(SUBJECT)))
    return op.unused(rows, "used", cohort, "key").select("row_id", "key")


def mark_first_subjects(spark, d):
    return op.mark_first_subjects(_manifest(spark, d), SUBJECT, 100).select("row_id", SUBJECT, "used")


def sampled_subjects(spark, d):
    """Ten subjects by hash, with their rows and those that were removed."""
    rows = _manifest(spark, d).where(F.col(SUBJECT).isNotNull())
    chosen = op.hashed_sample(rows.select(SUBJECT).distinct(), SUBJECT, 10)
    return rows.join(F.broadcast(chosen), SUBJECT, "left_semi").groupBy(SUBJECT).agg(F.count("*").alias("n_files"), F.count_if(F.col("removed_at").isNotNull()).alias("n_removed"))


def resolve_paths(spark, d):
    """Clean names with the paths of exports that end in .pdf or .tif.pdf."""
    listing = table(spark, d, "doc_5").select(F.concat(F.lit("in/"), F.trim("object_name")).alias("path"))
    return op.resolve_paths(op.clean(_manifest(spark, d), NAME, SUBJECT).select(NAME), listing, NAME, "path")


def warning_update(spark, d):
    """Ordering and censoring warnings per subject, with each manifest row as a page."""
    pages = _manifest(spark, d).where(F.col("warning_ordering").isNotNull() & (F.col("warning_ordering") != "") & F.col(SUBJECT).isNotNull())
    stage = F.when(F.col("warning_ordering") == "First stage", 1).when(F.col("warning_ordering") == "Second stage", 2).otherwise(3)
    made = pages.select(SUBJECT, stage.alias("stage"), (F.col("warning_censoring") == "large").alias("warned"), F.col("warning_censoring").alias("censor_warning"))
    return op.update_warnings(_manifest(spark, d).select(SUBJECT).dropna().distinct(), made, SUBJECT)


def _sources(spark, d):
    names = {"covariates": "ident_projet", "progress": "id", "combined_success_ids": SUBJECT, "manifest": SUBJECT}
    return {t: (table(spark, d, t), subject_key(F.col(c))) for t, c in names.items()}


def id_reconciliation(spark, d):
    sources = _sources(spark, d)
    return reconcile.differences(reconcile.presence(sources), list(sources))


def _waves(spark, d):
    keyed = lambda t: table(spark, d, t).select(subject_key(F.col(SUBJECT)).alias("key"), "q")
    return keyed("manifest"), keyed("combined_success_ids")


def missing_by_wave(spark, d):
    return reconcile.missing_by_wave(*_waves(spark, d))


def missing_flags(spark, d):
    return reconcile.missing_flags(*_waves(spark, d))


def progress_append(spark, d):
    return reconcile.append_new(table(spark, d, "progress"), subject_key(F.col("id")), table(spark, d, "combined_success_ids"), subject_key(F.col(SUBJECT)))


def transfer_ledger(spark, d):
    """The ledger of runs with every (subject, wave) of the manifest that it lacks."""
    key = subject_key(F.col(SUBJECT)).alias("id")
    files = _manifest(spark, d).select(key, "q", "row_id")
    return reconcile.transfer(files, table(spark, d, "combined_success_ids").select(key, "q").distinct(), ["id", "q"])[1]


def name_matching(spark, d):
    """Scans that only the manifest or only the exports name."""
    key = scan_key(F.col(NAME)).alias("name")
    return reconcile.name_mismatches(table(spark, d, "doc_5").select(key).dropna(), _manifest(spark, d).select(key).dropna(), "name")


_CLEAN = f"""SELECT object_name, min(e3n_id_hand) AS e3n_id_hand FROM (SELECT {sql.stem('object_name')} AS object_name, e3n_id_hand FROM manifest
  WHERE object_name IS NOT NULL AND e3n_id_hand IS NOT NULL) GROUP BY object_name HAVING count(DISTINCT e3n_id_hand) = 1"""
_UNDERSCORES = "length(object_name) - length(replace(object_name, '_', ''))"
_M, _S = (f"(SELECT DISTINCT {sql.subject('e3n_id_hand')} AS key, q FROM {t} WHERE {sql.subject('e3n_id_hand')} IS NOT NULL AND q IS NOT NULL)" for t in ("manifest", "combined_success_ids"))

QUERIES = {
    f.__name__: f
    for f in (
        manifest_clean, manifest_audit, files_per_subject, conflicting_names, name_length_distribution, underscore_distribution, shortest_names, fewest_underscores,
        last_subject_of_name, unused_of_cohort, mark_first_subjects, sampled_subjects, resolve_paths, warning_update, id_reconciliation, missing_by_wave,
        missing_flags, progress_append, transfer_ledger, name_matching,
    )
}
SQL = {
    "manifest_clean": f"SELECT object_name, e3n_id_hand, false AS used, '' AS warning_ordering, '' AS warning_censoring FROM ({_CLEAN})",
    "manifest_audit": """
WITH r AS (SELECT object_name AS n, e3n_id_hand AS s FROM manifest),
names AS (SELECT n, count(*) AS k, count(DISTINCT s) AS s FROM r WHERE n IS NOT NULL GROUP BY n),
subjects AS (SELECT s, count(*) AS k FROM r WHERE s IS NOT NULL GROUP BY s)
SELECT * FROM (
  SELECT 'rows' AS metric, count(*) AS value FROM r
  UNION ALL SELECT 'null_names', count(*) FROM r WHERE n IS NULL
  UNION ALL SELECT 'null_subjects', count(*) FROM r WHERE s IS NULL
  UNION ALL SELECT 'null_both', count(*) FROM r WHERE n IS NULL AND s IS NULL
  UNION ALL SELECT 'tif_names', count(*) FROM r WHERE lower(n) LIKE '%.tif'
  UNION ALL SELECT 'pdf_names', count(*) FROM r WHERE lower(n) LIKE '%.pdf'
  UNION ALL SELECT 'other_names', count(*) FROM r WHERE lower(n) NOT LIKE '%.tif' AND lower(n) NOT LIKE '%.pdf'
  UNION ALL SELECT 'repeated_rows', (SELECT count(*) FROM r) - (SELECT count(*) FROM (SELECT DISTINCT n, s FROM r))
  UNION ALL SELECT 'unique_names', count(*) FROM names
  UNION ALL SELECT 'repeated_names', count(*) FROM names WHERE k > 1
  UNION ALL SELECT 'rows_of_repeated_names', coalesce(sum(k), 0)::BIGINT FROM names WHERE k > 1
  UNION ALL SELECT 'names_with_more_subjects', count(*) FROM names WHERE s > 1
  UNION ALL SELECT 'unique_subjects', count(*) FROM subjects
  UNION ALL SELECT 'distinct_counts_per_subject', count(DISTINCT k) FROM subjects)""",
    "files_per_subject": "SELECT k AS n_files, count(*) AS n_subjects FROM (SELECT e3n_id_hand, count(DISTINCT object_name) AS k FROM manifest WHERE object_name IS NOT NULL AND e3n_id_hand IS NOT NULL GROUP BY 1) GROUP BY k",
    "conflicting_names": f"SELECT {sql.stem('object_name')} AS name, count(DISTINCT e3n_id_hand) AS n_subjects, min(e3n_id_hand) AS first_subject, max(e3n_id_hand) AS last_subject FROM manifest WHERE object_name IS NOT NULL GROUP BY 1 HAVING count(DISTINCT e3n_id_hand) > 1",
    "name_length_distribution": "SELECT length(object_name)::INT AS length, count(*) AS n_names FROM manifest WHERE object_name IS NOT NULL GROUP BY 1",
    "underscore_distribution": f"SELECT ({_UNDERSCORES})::INT AS n_underscores, count(*) AS n_names FROM manifest WHERE object_name IS NOT NULL GROUP BY 1",
    "shortest_names": "SELECT row_id AS position, object_name AS name, length(object_name)::INT AS length FROM manifest WHERE object_name IS NOT NULL ORDER BY 3, 1 LIMIT 20",
    "fewest_underscores": f"SELECT row_id AS position, object_name AS name, ({_UNDERSCORES})::INT AS n_underscores FROM manifest WHERE object_name IS NOT NULL ORDER BY 3, 1 LIMIT 20",
    "last_subject_of_name": "SELECT object_name AS name, e3n_id_hand AS subject FROM manifest WHERE object_name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY object_name ORDER BY row_id DESC) = 1",
    "unused_of_cohort": f"SELECT row_id, {sql.subject('e3n_id_hand')} AS key FROM manifest WHERE NOT coalesce(used, false) AND {sql.subject('e3n_id_hand')} IN (SELECT {sql.subject('ident_projet')} FROM covariates WHERE ident_projet IS NOT NULL)",
    "mark_first_subjects": "WITH u AS (SELECT row_id, e3n_id_hand FROM manifest WHERE NOT coalesce(used, false)) SELECT row_id, e3n_id_hand, coalesce(e3n_id_hand IN (SELECT DISTINCT e3n_id_hand FROM u WHERE e3n_id_hand IS NOT NULL ORDER BY 1 LIMIT 100), false) AS used FROM u",
    "sampled_subjects": "WITH s AS (SELECT DISTINCT e3n_id_hand FROM manifest WHERE e3n_id_hand IS NOT NULL ORDER BY md5('42|' || e3n_id_hand), e3n_id_hand LIMIT 10) SELECT e3n_id_hand, count(*) AS n_files, count(removed_at) AS n_removed FROM manifest WHERE e3n_id_hand IN (SELECT * FROM s) GROUP BY 1",
    "resolve_paths": f"""WITH f AS (SELECT DISTINCT trim(object_name, ' ') AS f FROM doc_5 WHERE object_name IS NOT NULL)
SELECT object_name, 'in/' || coalesce(a.f, b.f) AS path FROM ({_CLEAN}) c LEFT JOIN f a ON a.f = c.object_name || '.pdf' LEFT JOIN f b ON b.f = c.object_name || '.tif.pdf'""",
    "warning_update": """
WITH p AS (SELECT e3n_id_hand, CASE warning_ordering WHEN 'First stage' THEN 1 WHEN 'Second stage' THEN 2 ELSE 3 END AS stage, warning_censoring AS c FROM manifest WHERE warning_ordering IS NOT NULL AND warning_ordering <> '' AND e3n_id_hand IS NOT NULL),
g AS (SELECT e3n_id_hand, max(stage) AS stage, count(*) FILTER (WHERE c = 'large') AS w, count(*) AS n, max(c) FILTER (WHERE c <> '') AS c FROM p GROUP BY 1)
SELECT s.e3n_id_hand, CASE stage WHEN 1 THEN 'First stage' WHEN 2 THEN 'Second stage' WHEN 3 THEN 'OCR stage, pages with warning:   ' || w || '/' || n END AS warning_ordering, CASE WHEN n IS NOT NULL THEN coalesce(c, 'No warning') END AS warning_censoring
FROM (SELECT DISTINCT e3n_id_hand FROM manifest WHERE e3n_id_hand IS NOT NULL) s LEFT JOIN g ON g.e3n_id_hand = s.e3n_id_hand""",
    "id_reconciliation": f"""
WITH t AS (SELECT DISTINCT * FROM (SELECT 'covariates' AS s, {sql.subject('ident_projet')} AS k FROM covariates UNION ALL SELECT 'progress', {sql.subject('id')} FROM progress
  UNION ALL SELECT 'combined_success_ids', {sql.subject('e3n_id_hand')} FROM combined_success_ids UNION ALL SELECT 'manifest', {sql.subject('e3n_id_hand')} FROM manifest) WHERE k IS NOT NULL),
n AS (SELECT DISTINCT s FROM t)
SELECT a.s AS left_source, b.s AS right_source, (SELECT count(*) FROM t WHERE s = a.s) AS n_left, (SELECT count(*) FROM t WHERE s = b.s) AS n_right,
  (SELECT count(*) FROM t x JOIN t y ON x.k = y.k WHERE x.s = a.s AND y.s = b.s) AS n_both,
  (SELECT count(*) FROM t x WHERE x.s = a.s AND x.k NOT IN (SELECT k FROM t y WHERE y.s = b.s)) AS n_only_left,
  (SELECT min(k) FROM t x WHERE x.s = a.s AND x.k NOT IN (SELECT k FROM t y WHERE y.s = b.s)) AS example
FROM n a JOIN n b ON a.s <> b.s""",
    "missing_by_wave": f"SELECT coalesce(m.q, s.q) AS q, count(m.key) AS n_expected, count(s.key) AS n_found, count(*) FILTER (WHERE s.key IS NULL) AS n_missing, count(*) FILTER (WHERE m.key IS NULL) AS n_unexpected FROM {_M} m FULL JOIN {_S} s ON m.key = s.key AND m.q = s.q GROUP BY 1",
    "missing_flags": f"SELECT key, {', '.join(f'max((q = {q})::INT) AS q{q}_missing' for q in range(1, 14))} FROM (SELECT * FROM {_M} EXCEPT SELECT * FROM {_S}) GROUP BY key",
    "progress_append": f"SELECT id, false AS processed FROM (SELECT {sql.subject('e3n_id_hand')} AS id FROM combined_success_ids EXCEPT SELECT {sql.subject('id')} FROM progress) WHERE id IS NOT NULL",
    "transfer_ledger": f"WITH s AS (SELECT DISTINCT {sql.subject('e3n_id_hand')} AS id, q FROM combined_success_ids), m AS (SELECT key AS id, q FROM {_M}) SELECT * FROM s UNION ALL (SELECT * FROM m EXCEPT SELECT * FROM s)",
    "name_matching": f"""WITH a AS (SELECT DISTINCT {sql.scan('object_name')} AS n FROM doc_5), b AS (SELECT DISTINCT {sql.scan('object_name')} AS n FROM manifest)
SELECT coalesce(a.n, b.n) AS name, CASE WHEN a.n IS NULL THEN 'left' ELSE 'right' END AS missing_in FROM (FROM a WHERE n IS NOT NULL) a FULL JOIN (FROM b WHERE n IS NOT NULL) b ON a.n = b.n WHERE a.n IS NULL OR b.n IS NULL""",
}
