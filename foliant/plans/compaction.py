"""Problem 2: the tiny files of page records."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import compaction as op
from ..session import checkpoint_dir, cut, table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return op.redundant_copies(cut(op.record_index(table(spark, d, "page_file"), "file_id", "content")))


def p2_files(spark: SparkSession, d: str) -> DataFrame:
    """Bundles of about 8 MB written as zstandard frames to the shared folder and read again: records, distinct records and bytes of
    each, as written and as read."""
    made = op.bundles(table(spark, d, "page_file"), "file_id", "content", 8 << 20)
    written = op.write_bundles(made, f"{checkpoint_dir(spark)}/bundles-{uuid.uuid4().hex}", frames=True)
    read = op.read_bundles(written).groupBy("bundle_id").agg(F.count("*").alias("n_read"), F.count_distinct("record").alias("n_distinct"), F.sum(F.octet_length("record") + 1).alias("bytes_read"))
    return written.join(read, "bundle_id").select("bundle_id", "n_records", "n_read", "n_distinct", "n_bytes", "bytes_read", "n_frames", "file_bytes")


def p2_bundles(spark: SparkSession, d: str) -> DataFrame:
    return op.bundles(table(spark, d, "page_file"), "file_id", "content")


QUERIES = {"p2_found": p2_found, "p2_bundles": p2_bundles, "p2_files": p2_files}
_RECORD = r"""\{(?:[^"{}\[\]\r\n]|"(?:[^"\\\r\n]|\\[^\r\n])*")*\}"""
SQL = {
    # The table's records are flat objects of one line.
    "p2_found": f"""
WITH f AS (SELECT file_id, regexp_extract_all(content, '{_RECORD}') AS r FROM page_file), u AS (SELECT file_id, unnest(r) AS t, generate_subscripts(r, 1) AS i FROM f),
v AS (SELECT file_id, t::JSON AS t, row_number() OVER (PARTITION BY file_id ORDER BY i) - 1 AS record_no FROM u WHERE json_valid(t)),
c AS (SELECT file_id, record_no, coalesce(string_agg(e.key || chr(1) || CASE WHEN e.type = 'VARCHAR' THEN 's' || (e.value ->> '$') WHEN e.type IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'n' || (e.value::DOUBLE)::VARCHAR ELSE e.type || e.value::VARCHAR END, chr(2) ORDER BY e.key), '') AS same
  FROM v LEFT JOIN LATERAL (SELECT * FROM json_each(v.t)) e ON true GROUP BY 1, 2)
SELECT file_id, record_no FROM c QUALIFY row_number() OVER (PARTITION BY same ORDER BY file_id, record_no) > 1""",
}
