"""What to look at: members of groups and waves of subjects."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: columns that are no description of a subject.
NOT_SHOWN = re.compile(r"^(case_dt_date|q_\d+_num)|^_")


def subject_of(unique_id: Column) -> Column:
    return F.substring_index(unique_id, "_", 1)


def group_of(unique_id: Column) -> Column:
    """What follows the first underscore; empty without one."""
    return F.regexp_extract(unique_id, r"^[^_]*_?(.*)$", 1)


def is_case(c: Column) -> Column:
    return F.coalesce(F.lower(c.cast("string")).isin("1", "1.0", "true"), F.lit(False))


def waves_of(pattern: Column, waves: int = 13) -> Column:
    """Positions of 1 in a pattern; all waves for null."""
    every = F.sequence(F.lit(1), F.lit(waves))
    return F.when(pattern.isNull(), every).otherwise(F.filter(every, lambda q: F.substring(pattern, q, F.lit(1)) == "1"))


def select_waves(pattern: Column, last: Column, mode: str = "all", inclusive: bool = True, custom: list[int] | None = None) -> Column:
    """Waves to show: all of the pattern; those up to the last available one (`inclusive`: with it) or after it (`inclusive`:
    without it); the highest of the pattern; or given ones.

    Given waves are sorted, kept to those that exist, and not held against the pattern. A null last wave leaves all of the pattern's.
    """
    have = waves_of(pattern)
    if mode == "custom":
        return F.array(*(F.lit(q) for q in sorted({q for q in custom or [] if 1 <= q <= 13}))).cast("array<int>")
    if mode == "all":
        return have
    if mode == "upto_last_avail":
        return F.filter(have, lambda q: last.isNull() | ((q <= last) if inclusive else (q < last)))
    if mode == "after_last_avail":
        return F.filter(have, lambda q: last.isNull() | ((q > last) if inclusive else (q >= last)))
    if mode == "last_available":
        return F.slice(have, -1, 1)
    raise ValueError(f"unknown mode {mode!r}")


def select_group(df: DataFrame, group: str, subject: str, case_control: str, n_controls: int | None = 2, control_ids: list[str] | None = None) -> DataFrame:
    """All cases of each group, and its first n controls by subject, given controls, or all; with `position` in the group.

    Repeated rows of a subject stand next to each other and count each.
    """
    rows = df.withColumn("_case", is_case(F.col(case_control)))
    if control_ids is not None:
        rows = rows.where(F.col("_case") | F.col(subject).isin(control_ids))
    elif n_controls is not None:
        rank = F.row_number().over(Window.partitionBy(group, "_case").orderBy(F.col(subject).asc_nulls_last()))
        rows = rows.withColumn("_n", rank).where(F.col("_case") | (F.col("_n") <= n_controls)).drop("_n")
    order = Window.partitionBy(group).orderBy(F.desc("_case"), F.col(subject).asc_nulls_last())
    return rows.withColumn("position", F.row_number().over(order)).drop("_case")


def find_subject(df: DataFrame, key: str) -> DataFrame:
    """The first row with a unique id, else with a subject id."""
    rank = F.when(F.col("unique_id") == key, 0).when(subject_of(F.col("unique_id")) == key, 1)
    return df.withColumn("_rank", rank).where("_rank IS NOT NULL").orderBy("_rank", "unique_id").limit(1).drop("_rank")


def description(df: DataFrame) -> DataFrame:
    """Rows as a map of the columns that describe a subject."""
    shown = [c for c in df.columns if not NOT_SHOWN.search(c)]
    return df.select("unique_id", F.create_map(*(x for c in shown for x in (F.lit(c), F.col(c).cast("string")))).alias("description"))


def date_text(c: Column) -> Column:
    return F.coalesce(F.left(c.cast("string"), F.lit(19)), F.lit("-"))


def group_grid(df: DataFrame, group: str, subject: str, pattern: str) -> DataFrame:
    """Each member of a group with each wave that any member has, and whether it is there: gaps show."""
    have = df.select(group, subject, F.explode(waves_of(F.col(pattern))).alias("q")).distinct()
    every = have.select(group, "q").distinct()
    members = df.select(group, subject).distinct()
    grid = members.join(every, group)
    return grid.join(have.withColumn("_here", F.lit(True)), [group, subject, "q"], "left").select(group, subject, "q", F.coalesce("_here", F.lit(False)).alias("present"))


def search(df: DataFrame, splits: list[str] | None = None, cases_only: bool | None = None, contains: str | None = None) -> DataFrame:
    """Rows by split, by case or control, and by part of the unique id in any letter case."""
    rows = df if splits is None else df.where(F.col("split").isin(splits))
    if cases_only is not None:
        rows = rows.where(is_case(F.col("case_control")) == F.lit(cases_only))
    return rows if not contains else rows.where(F.lower("unique_id").contains(contains.lower()))
