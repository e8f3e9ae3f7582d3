"""Risk-set matching of cases with controls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cohort import WAVES, YEAR
from .skew import numbered

MODES = ("exact", "at_least", "exact_w_fallback")


def exclude_assisted(df: DataFrame, everyone: bool = False) -> DataFrame:
    """Without subjects who had help with wave 11, or whose help there is unknown and who had help with wave 12; cases stay
    unless `everyone`."""
    helped = (F.col("rempli_seulq11") == 0) | ((F.col("rempli_seulq11") == 9) & (F.col("rempli_seulq12") == 0))
    goes = F.coalesce(helped, F.lit(False)) & (F.lit(everyone) | ~F.coalesce(F.col("is_case") == 1, F.lit(False)))
    return df.where(~goes)


def with_risk_time(df: DataFrame, entry: str = "dateq1", exit_: str = "exit_date", birth: str = "birth_date", waves: int = WAVES) -> DataFrame:
    """The cohort with follow-up in years, age in whole years over the oldest, availability bits and the last wave before exit.

    Ages count from the least birth date of all rows given. The last wave is the last one filled before the first wave dated
    at or after the exit; 0 if there is none.
    """
    least = F.broadcast(df.agg(F.min(birth).alias("_least")))
    dates = F.array(*(F.col(f"dateq{q}") for q in range(1, waves + 1)))
    every = F.sequence(F.lit(1), F.lit(waves))
    bits = F.aggregate(every, F.lit(0).cast("long"), lambda a, q: a + F.when(F.get(F.col("_dates"), q - 1).isNotNull(), F.call_function("shiftleft", F.lit(1).cast("long"), q - 1)).otherwise(F.lit(0).cast("long")))
    cutoff = F.coalesce(F.get(F.filter(every, lambda q: F.get(F.col("_dates"), q - 1) >= F.col(exit_)), F.lit(0)), F.lit(waves))
    last = F.coalesce(F.array_max(F.filter(every, lambda q: (q < F.col("_cutoff")) & F.get(F.col("_dates"), q - 1).isNotNull())), F.lit(0))
    out = df.join(least).withColumn("_dates", dates).withColumns({
        "follow_up_time": F.datediff(exit_, entry) / YEAR,
        "relative_age": F.bround(F.datediff(birth, "_least") / YEAR).cast("int"),
        "available": bits,
        "_cutoff": cutoff,
    })
    return out.withColumn("last_q", last).drop("_least", "_cutoff", "_dates")


def _rank(seed: int, case: Column, control: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), case.cast("string"), control.cast("string")))


def candidates(cohort: DataFrame, id_col: str, columns: Sequence[str], age_window: int) -> DataFrame:
    """Pairs (case, control) that are equal in the columns and near in age, with a control followed up at least as long.

    Ages within a window become an equi-join: each case stands once for every age it accepts. Nulls match nothing.
    Of repeated ids the row with the least values counts.
    """
    one = cohort.groupBy(id_col).agg(F.min(F.struct(*(c for c in cohort.columns if c != id_col))).alias("_r")).select(id_col, "_r.*")
    cases = one.where((F.col("is_case") == 1) & (F.col("last_q") > 0)).select(
        F.col(id_col).alias("case_id"), F.col("follow_up_time").alias("case_time"), "last_q", F.col("available").alias("case_available"), *columns, F.col("relative_age").alias("case_age")
    )
    others = one.select(F.col(id_col).alias("control_id"), "follow_up_time", F.col("available").alias("control_available"), *columns, F.col("relative_age").alias("age"))
    keys = list(columns)
    if age_window >= 0:
        cases = cases.withColumn("age", F.explode(F.sequence(F.col("case_age") - age_window, F.col("case_age") + age_window)))
        keys.append("age")
    if not keys:
        raise ValueError("candidates need a column or an age window in common: without one, every case would be held against every subject")
    pairs = cases.join(others, keys)
    return pairs.where((F.col("follow_up_time") >= F.col("case_time")) & (F.col("case_id") != F.col("control_id")))


def match(cohort: DataFrame, n: int, mode: str, age_window: int = 1, columns: Sequence[str] = ("etudegp", "profq2"), id_col: str = "id", seed: int = 42) -> DataFrame:
    """Each case with up to n controls: `match_group, case_id, member_id, case_control, last_q, tier`, and on each row the
    case's numbers of candidates: by risk set and columns, with equal and with at least equal availability, and left.

    exact: controls with the case's availability up to its last wave. at_least: or more. exact_w_fallback: at least equal
    ones fill up where equal ones are fewer than n. Controls are drawn in the order of a seeded hash, and may serve several cases.
    Groups are numbered by case id; cases without candidates are groups of one, and those without any wave have none.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is none of {MODES}")
    prefix = F.expr("shiftleft(1L, last_q) - 1")
    pairs = candidates(cohort, id_col, columns, age_window)
    own, its = F.col("case_available").bitwiseAND(prefix), F.col("control_available").bitwiseAND(prefix)
    pairs = pairs.select("case_id", "control_id", (own == its).alias("exact"), (its.bitwiseAND(own) == own).alias("enough"))
    counted = pairs.groupBy("case_id").agg(F.count("*").alias("n_candidates"), F.count_if("exact").alias("n_exact"), F.count_if("enough").alias("n_at_least"))
    tier = F.when(F.col("exact"), 0).otherwise(1) if mode == "exact_w_fallback" else F.lit(0)
    fitting = pairs.where("exact" if mode == "exact" else "enough").withColumn("tier", tier)
    order = Window.partitionBy("case_id").orderBy("tier", _rank(seed, F.col("case_id"), F.col("control_id")), "control_id")
    drawn = fitting.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).select("case_id", F.col("control_id").alias("member_id"), F.lit(0).alias("case_control"), "tier")
    cases = cohort.where((F.col("is_case") == 1) & (F.col("last_q") > 0)).groupBy(F.col(id_col).alias("case_id")).agg(F.min("last_q").alias("last_q"))
    zero = F.lit(0).cast("long")
    numbers = numbered(cases, "case_id", "match_group").join(counted, "case_id", "left").select("case_id", "match_group", "last_q", *(F.coalesce(c, zero).alias(c) for c in ("n_candidates", "n_exact", "n_at_least")))
    left = {"exact": F.col("n_exact"), "at_least": F.col("n_at_least")}.get(mode, F.when(F.col("n_exact") >= n, F.col("n_exact")).otherwise(F.least(F.lit(n), F.col("n_at_least"))))
    numbers = numbers.withColumn("n_left", left.cast("long"))
    itself = numbers.select("case_id", F.col("case_id").alias("member_id"), F.lit(1).alias("case_control"), F.lit(0).alias("tier"))
    return drawn.unionByName(itself).join(numbers, "case_id")


def failed(cohort: DataFrame, matched: DataFrame, id_col: str = "id") -> DataFrame:
    """`case_id, reason` of cases without a wave before exit, and of those without a match."""
    never = cohort.where((F.col("is_case") == 1) & (F.col("last_q") == 0)).select(F.col(id_col).alias("case_id")).distinct().withColumn("reason", F.lit("no_questionnaires"))
    none = matched.where((F.col("case_control") == 1) & (F.col("n_left") == 0)).select("case_id", F.lit("no_matches").alias("reason"))
    return never.unionByName(none)


def summary(matched: DataFrame, n: int) -> DataFrame:
    """One row: groups, cases, controls in all and by subject, how often they are used again, and groups short of n."""
    groups = matched.groupBy("match_group").agg(F.count("*").alias("size"), F.max("tier").alias("tier"))
    g = groups.agg(F.count("*").alias("n_groups"), F.count_if(F.col("size") <= n).alias("n_short"), F.count_if(F.col("tier") > 0).alias("n_fallback"), F.min("size").alias("least_size"), F.max("size").alias("most_size"))
    uses = matched.where("case_control = 0").groupBy("member_id").agg(F.count("*").alias("uses"))
    u = uses.agg(F.count("*").alias("n_unique_controls"), F.coalesce(F.sum("uses"), F.lit(0)).alias("n_controls"), F.count_if(F.col("uses") > 3).alias("n_used_over_3"), F.count_if(F.col("uses") > 5).alias("n_used_over_5"), F.coalesce(F.max("uses"), F.lit(0)).alias("most_uses"))
    return g.join(F.broadcast(u))


def group_sizes(matched: DataFrame) -> DataFrame:
    return matched.groupBy("match_group").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("n_groups"))


def upsert(table: DataFrame, row: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A table with rows of equal keys replaced, and new ones added."""
    return table.join(row.select(*keys), list(keys), "left_anti").unionByName(row)
