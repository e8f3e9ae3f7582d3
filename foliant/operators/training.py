"""The training table of matched groups, and splits drawn in the order of a seeded hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .cohort import WAVES


def hashed(seed: int, key: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), key.cast("string")))


def ranked(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Distinct keys with `rank`, from 0, in the order of their hash, and `total`.

    The rank is a count within and over 4,096 ranges of the hash, so that no task orders all keys.
    """
    keys = df.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_h", hashed(seed, F.col(key))).withColumn("_p", F.substring("_h", 1, 3))
    parts = keys.groupBy("_p").agg(F.count("*").alias("_c"))
    parts = parts.select("_p", (F.sum("_c").over(Window.orderBy("_p")) - F.col("_c")).alias("_base"), F.sum("_c").over(Window.partitionBy()).alias("total"))
    inner = Window.partitionBy("_p").orderBy("_h", key)
    return keys.join(F.broadcast(parts), "_p").select(key, (F.col("_base") + F.row_number().over(inner) - 1).alias("rank"), "total")


def assign_sized(df: DataFrame, key: str, n_train: int, n_val: int, n_test: int, seed: int = 42) -> DataFrame:
    """`key, split`: the first keys train, the next val, the next test, the others null; an error if there are too few."""
    out = ranked(df, key, seed).select(
        key,
        F.when(F.col("total") < n_train + n_val + n_test, F.raise_error(F.lit("more keys asked for than there are")))
        .when(F.col("rank") < n_train, "train").when(F.col("rank") < n_train + n_val, "val").when(F.col("rank") < n_train + n_val + n_test, "test").cast("string").alias("split"),
    )
    return out


def assign_groups(df: DataFrame, group: str, test: float = 0.1, val: float = 0.1, seed: int = 42) -> DataFrame:
    """`group, split`: of n groups, test * n rounded down test, val of the rest rounded down val, and train."""
    n_test = F.floor(F.col("total") * F.lit(test))
    n_val = F.floor((F.col("total") - n_test) * F.lit(val))
    n_train = F.col("total") - n_test - n_val
    return ranked(df, group, seed).select(group, F.when(F.col("rank") < n_train, "train").when(F.col("rank") < n_train + n_val, "val").otherwise("test").alias("split"))


def one_split_per_subject(df: DataFrame, subject: str, case_control: str, group: str) -> DataFrame:
    """Rows with the split of their subject's row as a case, else of the row in the lowest group."""
    rank = F.struct((-F.coalesce(F.col(case_control), F.lit(0))).alias("c"), F.col(group).alias("g"))
    chosen = df.where("split IS NOT NULL").groupBy(subject).agg(F.min_by("split", rank).alias("_split"))
    return df.join(chosen, subject, "left").withColumn("split", F.col("_split")).drop("_split")


def drop_flagged(df: DataFrame, flag: str, group: str, case_control: str) -> DataFrame:
    """Without flagged rows and without all rows of groups whose case is flagged. A null flag counts as not flagged."""
    bad = df.where((F.col(flag) == 1) & (F.col(case_control) == 1)).select(group).distinct()
    return df.where(F.coalesce(F.col(flag), F.lit(0)) == 0).join(bad, group, "left_anti")


def training_table(matched: DataFrame, subjects: DataFrame, exit_: str = "exit_date", waves: int = WAVES, split: bool = True, seed: int = 42) -> DataFrame:
    """One row per group member with its own and its case's facts.

    `matched` has match_group, member_id, case_control, last_q; `subjects` has id, flagged, rempli_pattern, grid_pattern, the
    exit date and dateq columns, and facts to keep. Adds unique_id (subject and group, of one width), split (by group,
    then one per subject), the case's patterns, years from the case's exit to each of its waves, and at_least_warning: 1 if the member's
    pattern up to the last wave is not the case's.
    """
    rows = matched.join(subjects.withColumnRenamed("id", "member_id"), "member_id")
    rows = cut(drop_flagged(rows, "flagged", "match_group", "case_control"))
    if split:
        rows = rows.join(assign_groups(rows, "match_group", seed=seed), "match_group", "left")
        rows = one_split_per_subject(rows, "member_id", "case_control", "match_group")
    width = F.broadcast(rows.agg(F.length(F.max("match_group").cast("string")).alias("_w")))
    number = F.col("match_group").cast("string")
    rows = rows.join(width).withColumn("unique_id", F.concat("member_id", F.lit("_"), F.lpad(number, F.greatest(F.length(number), F.col("_w")), F.lit("0")))).drop("_w")
    dates = [f"dateq{q}" for q in range(1, waves + 1)]
    offsets = [(F.datediff(c, exit_) / 365.25).alias(f"case_dt_{c}") for c in dates]
    cases = rows.where("case_control = 1").select("match_group", F.col("rempli_pattern").alias("case_pattern"), F.col("grid_pattern").alias("case_grid_pattern"), *offsets)
    out = rows.join(cases, "match_group", "left")
    own, its = F.substring(F.col("rempli_pattern"), F.lit(1), F.col("last_q")), F.substring(F.col("case_pattern"), F.lit(1), F.col("last_q"))
    return out.withColumn("at_least_warning", (~own.eqNullSafe(its)).cast("int"))


def single_split(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """`key, split`: with t = 20 % and v = 10 % of the rest, both rounded down, v keys val, then t + 1 test, then train."""
    n_test = F.floor(F.col("total") * F.lit(0.2))
    n_val = F.floor((F.col("total") - n_test) * F.lit(0.1))
    return ranked(df, key, seed).select(key, F.when(F.col("rank") < n_val, "val").when(F.col("rank") <= n_val + n_test, "test").otherwise("train").alias("split"))


def balanced_by_tertile(df: DataFrame, key: str, label: str, size: str, n_negatives: int, test: float = 0.1, val: float = 0.1, seed: int = 42) -> DataFrame:
    """`key, label, bin, split`: in each third of a size (right-closed, by linear quantiles) all keys with label 1 and
    n_negatives times as many with 0, drawn by hash, then split within the third in the order of `single_split`, with a test
    share of the third and a val share of the rest."""
    rows = df.where(F.col(label).isNotNull() & F.col(size).isNotNull()).select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(size).alias("size"))
    cuts = F.broadcast(rows.agg(F.percentile("size", F.array(F.lit(1 / 3), F.lit(2 / 3))).alias("_c")))
    binned = rows.join(cuts).withColumn("bin", F.when(F.col("size") <= F.col("_c")[0], 1).when(F.col("size") <= F.col("_c")[1], 2).otherwise(3)).drop("_c")
    positives = binned.groupBy("bin").agg(F.count_if(F.col("label") == 1).alias("_pos"))
    order = Window.partitionBy("bin", "label").orderBy(hashed(seed, F.col("key")), "key")
    drawn = binned.join(F.broadcast(positives), "bin").withColumn("_n", F.row_number().over(order)).where((F.col("label") == 1) | (F.col("_n") <= n_negatives * F.col("_pos")))
    again = Window.partitionBy("bin").orderBy(hashed(seed + 1, F.col("key")), "key")
    total = F.count("*").over(Window.partitionBy("bin"))
    n_test = F.floor(F.col("_t") * F.lit(test))
    n_val = F.floor((F.col("_t") - n_test) * F.lit(val))
    numbered = drawn.withColumns({"_r": F.row_number().over(again) - 1, "_t": total})
    return numbered.select("key", "label", "bin", F.when(F.col("_r") < n_val, "val").when(F.col("_r") <= n_val + n_test, "test").otherwise("train").alias("split"))
