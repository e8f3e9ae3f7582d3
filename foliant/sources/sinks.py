"""Tables and texts written out."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, notes: Mapping[str, str], mode: str = "overwrite") -> None:
    """Parquet files, and beside them one line of JSON with notes on the table, as footers can't be set here."""
    df.write.mode(mode).parquet(path)
    line = json.dumps({**notes, "columns": df.columns}, sort_keys=True)
    df.sparkSession.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path.rstrip("/") + ".notes")


def write_label_files(rows: DataFrame, path: str) -> None:
    """Rows of `file_name, box_no, line` as text, a folder per file; files without boxes get an empty line's file."""
    ordered = rows.groupBy("file_name").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("box_no", "line"))), lambda x: F.coalesce(x["line"], F.lit(""))), "\n").alias("value"))
    ordered.write.mode("overwrite").partitionBy("file_name").text(path)


def write_xml(images: DataFrame, path: str) -> None:
    images.write.mode("overwrite").format("xml").option("rootTag", "annotations").option("rowTag", "image").save(path)


def write_delimited(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").option("header", True)
    (writer.partitionBy(*by) if by else writer).csv(path)


def write_members(df: DataFrame, folder: str, name: str = "name", content: str = "content") -> None:
    """Binary contents as files of a shared folder, each written whole under another name and then renamed."""

    def save(rows) -> None:
        import os

        for r in rows:
            path = os.path.join(folder, os.path.basename(r[name]))
            with open(path + ".part", "wb") as f:
                f.write(r[content])
            os.replace(path + ".part", path)

    df.select(name, content).foreachPartition(save)


def page_log(placed: DataFrame, pages: DataFrame) -> DataFrame:
    """A row per page: where a stage put it, and defaults for pages that none did."""
    return pages.select("doc", "page").join(placed, ["doc", "page"], "left").select(
        "doc", "page", "template", F.coalesce("stage", F.lit(-1)).alias("stage"), F.coalesce("warned", F.lit(False)).alias("warned"), F.col("template").isNull().alias("unplaced"), F.coalesce(F.col("cost") > 0.7, F.lit(False)).alias("discarded")
    )
