"""Cleaning and audits of manifests: which file belongs to which subject."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stem(c: Column) -> Column:
    """A name without its last extension."""
    return F.regexp_replace(c, r"\.[^.]*$", "")


def before_first_dot(c: Column) -> Column:
    return F.substring_index(c, ".", 1)


def clean(df: DataFrame, name: str, subject: str) -> DataFrame:
    """One row per file whose rows all name one subject: `name, subject, used, warning_ordering, warning_censoring`.

    Rows with a null are dropped, then the last extension, then names with two subjects, then repeated rows. A name with
    one subject has one row left, so all of this is one aggregation that combines before its shuffle, whatever the skew.
    """
    pairs = df.select(stem(F.col(name)).alias(name), F.col(subject)).dropna()
    one = pairs.groupBy(name).agg(F.min(subject).alias(subject), F.max(subject).alias("_other")).where(F.col(subject) == F.col("_other"))
    return one.select(name, subject, F.lit(False).alias("used"), F.lit("").alias("warning_ordering"), F.lit("").alias("warning_censoring"))


def audit(df: DataFrame, name: str, subject: str) -> DataFrame:
    """`metric, value`: nulls, endings, repetitions and conflicts of (name, subject) rows.

    Nulls count as values of repeated rows, and not as subjects or names. All numbers come from one count per
    distinct pair, itself counted by name and by subject.
    """
    pairs = df.groupBy(F.col(name).alias("name"), F.col(subject).alias("subject")).agg(F.count("*").alias("n"))
    low = F.lower("name")
    no_ending = ~low.endswith(".tif") & ~low.endswith(".pdf")
    base = pairs.agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("name").isNull(), F.col("n"))).alias("null_names"),
        F.sum(F.when(F.col("subject").isNull(), F.col("n"))).alias("null_subjects"),
        F.sum(F.when(F.col("name").isNull() & F.col("subject").isNull(), F.col("n"))).alias("null_both"),
        F.sum(F.when(low.endswith(".tif"), F.col("n"))).alias("tif_names"),
        F.sum(F.when(low.endswith(".pdf"), F.col("n"))).alias("pdf_names"),
        F.sum(F.when(no_ending, F.col("n"))).alias("other_names"),
        F.sum(F.col("n") - 1).alias("repeated_rows"),
    )
    by_name = pairs.where("name IS NOT NULL").groupBy("name").agg(F.sum("n").alias("n"), F.count("subject").alias("subjects"))
    names = by_name.agg(
        F.count("*").alias("unique_names"),
        F.count_if(F.col("n") > 1).alias("repeated_names"),
        F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("rows_of_repeated_names"),
        F.count_if(F.col("subjects") > 1).alias("names_with_more_subjects"),
    )
    by_subject = pairs.where("subject IS NOT NULL").groupBy("subject").agg(F.sum("n").alias("n")).groupBy("n").agg(F.count("*").alias("k"))
    subjects = by_subject.agg(F.sum("k").alias("unique_subjects"), F.count("*").alias("distinct_counts_per_subject"))
    return reduce(DataFrame.unionByName, (_long(x) for x in (base, names, subjects)))


def _long(row: DataFrame) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("metric"), F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias("value")) for c in row.columns]
    return row.select(F.inline(F.array(*cells)))


def files_per_subject(df: DataFrame, name: str, subject: str) -> DataFrame:
    """`n_files, n_subjects` over distinct pairs without nulls."""
    pairs = df.select(name, subject).dropna().distinct()
    return pairs.groupBy(subject).agg(F.count("*").alias("n_files")).groupBy("n_files").agg(F.count("*").alias("n_subjects"))


def repeated_names(df: DataFrame, name: str, subject: str) -> DataFrame:
    """Names with more than one subject, those subjects' number, the first and the last."""
    got = df.groupBy(stem(F.col(name)).alias("name")).agg(F.count_distinct(subject).alias("n_subjects"), F.min(subject).alias("first_subject"), F.max(subject).alias("last_subject"))
    return got.where("name IS NOT NULL AND n_subjects > 1")


def name_lengths(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col(name).isNotNull()).groupBy(F.length(name).alias("length")).agg(F.count("*").alias("n_names"))


def underscores(df: DataFrame, name: str) -> DataFrame:
    n = F.length(name) - F.length(F.replace(F.col(name), F.lit("_"), F.lit("")))
    return df.where(F.col(name).isNotNull()).groupBy(n.alias("n_underscores")).agg(F.count("*").alias("n_names"))


def shortest_names(df: DataFrame, name: str, position: str, k: int = 20) -> DataFrame:
    """The k shortest names, ties by position."""
    return df.where(F.col(name).isNotNull()).select(F.col(position).alias("position"), F.col(name).alias("name"), F.length(name).alias("length")).orderBy("length", "position").limit(k)


def fewest_underscores(df: DataFrame, name: str, position: str, k: int = 20) -> DataFrame:
    n = F.length(name) - F.length(F.replace(F.col(name), F.lit("_"), F.lit("")))
    return df.where(F.col(name).isNotNull()).select(F.col(position).alias("position"), F.col(name).alias("name"), n.alias("n_underscores")).orderBy("n_underscores", "position").limit(k)


def last_subject(df: DataFrame, name: str, subject: str, position: str) -> DataFrame:
    """`name, subject` of each name's last row."""
    return df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("name")).agg(F.max_by(subject, position).alias("subject"))


def resolve_paths(manifest: DataFrame, listing: DataFrame, name: str, path: str) -> DataFrame:
    """The manifest with the listed path of `name.pdf`, else of `name.tif.pdf`, else null."""
    files = listing.groupBy(F.element_at(F.split(path, "/"), -1).alias("_file")).agg(F.min(path).alias("path"))
    pdf, tif = F.concat(name, F.lit(".pdf")), F.concat(name, F.lit(".tif.pdf"))
    first = manifest.join(files.withColumnRenamed("path", "_pdf"), pdf == F.col("_file"), "left").drop("_file")
    both = first.join(files.withColumnRenamed("path", "_tif"), tif == F.col("_file"), "left").drop("_file")
    return both.withColumn("path", F.coalesce("_pdf", "_tif")).drop("_pdf", "_tif")


def unused(df: DataFrame, used: str, subjects: DataFrame | None = None, subject: str | None = None) -> DataFrame:
    """Rows not used yet, of some subjects if given."""
    rows = df.where(~F.coalesce(F.col(used), F.lit(False)))
    return rows if subjects is None else rows.join(subjects.select(subject).distinct(), subject, "left_semi")


def mark_first_subjects(df: DataFrame, subject: str, n: int, used: str = "used") -> DataFrame:
    """Unused rows, with those of the first n subjects in order marked used."""
    rows = unused(df, used)
    chosen = rows.where(F.col(subject).isNotNull()).select(subject).distinct().orderBy(subject).limit(n).withColumn("_chosen", F.lit(True))
    return rows.join(F.broadcast(chosen), subject, "left").withColumn(used, F.coalesce("_chosen", F.lit(False))).drop("_chosen")


def hashed_sample(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """k rows in the order of a hash of a key: the same on every run and engine."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"))), key).limit(k)


def update_warnings(subjects: DataFrame, pages: DataFrame, subject: str) -> DataFrame:
    """Ordering and censoring warnings of each subject from its pages.

    `pages` has the subject, stage (1 to 3: where the page was placed), warned and censor_warning. The worst stage names
    the ordering warning; for the third, with the pages warned of and all pages. Subjects without pages have nulls.
    """
    per = pages.groupBy(subject).agg(F.max("stage").alias("_stage"), F.count_if(F.col("warned")).alias("_warned"), F.count("*").alias("_pages"), F.max(F.when(F.col("censor_warning") != "", F.col("censor_warning"))).alias("_censor"))
    ordering = F.when(F.col("_stage") == 1, "First stage").when(F.col("_stage") == 2, "Second stage").when(F.col("_stage") == 3, F.format_string("OCR stage, pages with warning:   %d/%d", F.col("_warned"), F.col("_pages")))
    censoring = F.when(F.col("_pages").isNotNull(), F.coalesce("_censor", F.lit("No warning")))
    return subjects.join(per, subject, "left").withColumns({"warning_ordering": ordering, "warning_censoring": censoring}).drop("_stage", "_warned", "_pages", "_censor")


def page_ranks(df: DataFrame, by: str, order: str) -> DataFrame:
    """Rows with their position within a group: the n-th sorted file stands for page n."""
    return df.withColumn("page", F.row_number().over(Window.partitionBy(by).orderBy(order)))
