"""Files as tables: listings, delimited tables, annotation files, images and archive members."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..operators.annotations import IMAGE


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"\.[^.]*$", "")


def listing(spark: SparkSession, folder: str, endings: Sequence[str] | None = None, recursive: bool = False) -> DataFrame:
    """`path, name, n_bytes, modified` of files with one of some endings, in any letter case; contents are not read.

    A folder that doesn't exist raises an error; hidden files are left out.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if endings:
        letters = lambda e: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e.lstrip("."))
        reader = reader.option("pathGlobFilter", "*.{" + ",".join(letters(e) for e in endings) + "}")
    return reader.load(folder).select("path", base_name(F.col("path")).alias("name"), F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified"))


def folders(files: DataFrame) -> DataFrame:
    """Distinct folders of listed files, without hidden ones."""
    rows = files.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder")).distinct()
    return rows.where(~base_name(F.col("folder")).startswith("."))


def with_page_number(files: DataFrame) -> DataFrame:
    """Files with the whole number after the last underscore of their stems; an error if there is none."""
    number = F.substring_index(stem(F.col("path")), "_", -1)
    page = F.when(number.rlike(r"^[0-9]{1,9}$"), number.cast("int")).otherwise(F.raise_error(F.concat(F.lit("no page number: "), F.col("path"))).cast("int"))
    return files.withColumn("page", page)


def done(files: DataFrame) -> DataFrame:
    return files.where(F.col("path").contains("_done"))


def delimited(spark: SparkSession, path: str | list[str], schema: StructType | str, sep: str = ",", encoding: str = "UTF-8", without: str | None = None) -> DataFrame:
    """Rows of delimited files with headers. Windows encodings need the session's `spark.sql.legacy.javaCharsets`, set here.
    A file of one name may be left out."""
    if encoding.upper() not in ("UTF-8", "US-ASCII", "ISO-8859-1", "UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32"):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    df = spark.read.csv(path, schema=schema, header=True, sep=sep, encoding=encoding)
    return df if without is None else df.where(F.col("_metadata.file_name") != without)


def table_of(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A training table, of Parquet or delimited files by the path's ending, with subject_id and group_id of its unique_id."""
    df = delimited(spark, path, schema, "\t" if path.endswith(".tsv") else ",") if path.endswith((".csv", ".tsv")) and schema else spark.read.parquet(path)
    from ..operators.selection import group_of, subject_of

    return df.withColumns({"subject_id": subject_of(F.col("unique_id")), "group_id": group_of(F.col("unique_id"))})


def annotation_json(spark: SparkSession, path: str) -> DataFrame:
    """`path, name, body` of whole JSON files, to be read by the annotation operators."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), stem(F.col("_metadata.file_path")).alias("name"), F.col("value").alias("body"))


def annotation_xml(spark: SparkSession, path: str) -> DataFrame:
    """Images of XML annotation files; the schema is given, as inference would take a single attribute for no list."""
    return spark.read.format("xml").option("rowTag", "image").schema(IMAGE).load(path)


def images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images of 8 bits: `origin, height, width, n_channels, data` (rows of blue, green, red)."""
    return spark.read.format("image").option("dropInvalid", False).load(path).select("image.origin", "image.height", "image.width", F.col("image.nChannels").alias("n_channels"), "image.data")


def member_key(name: Column) -> Column:
    """An archive member's name with / for \\, without a leading ./, in lower case."""
    return F.lower(F.regexp_replace(F.replace(name, F.lit("\\"), F.lit("/")), r"^(\./)+", ""))


def find_members(members: DataFrame, key: str) -> DataFrame:
    """Each archive's member of a name, else the first of those that end in it."""
    wanted = re.sub(r"^(\./)+", "", key.replace("\\", "/")).lower()
    rank = F.when(F.col("member") == wanted, 0).when(F.col("member").endswith("/" + wanted), 1)
    rows = members.withColumn("_rank", rank).where("_rank IS NOT NULL")
    rest = [c for c in members.columns if c != "archive"]
    return rows.groupBy("archive").agg(F.min_by(F.struct(*rest), F.struct("_rank", "member")).alias("m")).select("archive", "m.*")


def page_members(members: DataFrame) -> DataFrame:
    """`archive, page, member` of page images: the number at the end of the name; of one page's names the first."""
    number = F.regexp_extract("member", r"([0-9]+)\.png$", 1)
    return members.where(number != "").groupBy("archive", number.cast("int").alias("page")).agg(F.min("member").alias("member"))


def waves_in(members: DataFrame) -> DataFrame:
    """`archive, qs` of the questionnaires whose folders an archive holds."""
    q = F.regexp_extract("member", r"(?:^|/)q([0-9]+)/", 1)
    return members.where(q != "").groupBy("archive").agg(F.sort_array(F.collect_set(q.cast("int"))).alias("qs"))


def modalities(members: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """`archive, q, modality, position` of images under a questionnaire's folder: known ones in their order, then by name."""
    q, name = F.regexp_extract("member", r"(?:^|/)q([0-9]+)/[^/]+\.png$", 1), F.regexp_extract("member", r"([^/]+)\.png$", 1)
    rows = members.where(q != "").select("archive", q.cast("int").alias("q"), name.alias("modality")).distinct()
    known = F.array(*(F.lit(o) for o in order)) if order else F.array().cast("array<string>")
    at = F.array_position(known, F.col("modality"))
    return rows.withColumn("position", F.when(at > 0, at).otherwise(F.lit(len(order) + 1)))


class TarReader(DataSourceReader):
    """Members of tar files, one task per archive; contents go out one by one."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.pattern = options["path"], re.compile(options.get("members", ""), re.IGNORECASE)
        self.contents = options.get("contents", "true") == "true"

    def partitions(self) -> list[InputPartition]:
        import glob

        return [InputPartition(p) for p in sorted(glob.glob(self.path))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import tarfile

        with tarfile.open(partition.value) as tar:
            for m in tar:
                name = m.name.replace("\\", "/")
                name = re.sub(r"^(\./)+", "", name).lower()
                if m.isfile() and self.pattern.search(name):
                    yield partition.value, name, m.size, tar.extractfile(m).read() if self.contents else None


class Tar(DataSource):
    """`spark.read.format("tar")` over a glob on a shared file system: `archive, member, n_bytes, content`. Options: `members`, a
    pattern of names; `contents`, false to list only. Members are read, never extracted to paths of their own."""

    @classmethod
    def name(cls) -> str:
        return "tar"

    def schema(self) -> str:
        return "archive string, member string, n_bytes long, content binary"

    def reader(self, schema: StructType) -> TarReader:
        return TarReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Tar)
