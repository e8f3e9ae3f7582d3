"""Cohort tables: recoded covariates, availability of waves, and their checks.

Fixed values: 9 stands for a missing answer, -1 for what was not processed, 365.25 days for a year, 13 waves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WAVES = 13
YEAR = 365.25


def day(c: Column) -> Column:
    """A date written like 05JAN1990 in any letter case; null if it can't be read."""
    text = F.trim(c)
    return F.when(F.length(text) == 9, F.try_to_date(text, "ddMMMyyyy"))


def years(a: Column, b: Column) -> Column:
    """Years from a to b, by days."""
    return F.datediff(b, a) / YEAR


def recode(df: DataFrame, waves: int = WAVES) -> DataFrame:
    """Covariates for matching, one row per row.

    Profession: 1 if it starts with ENE, 9 if null, else 0. Null flags become 9. Subjects to exclude go, those with
    a null flag stay. Dates that can't be read are null. Age at entry is in years, and rounded half to even.
    """
    dates = [f"dateq{q}" for q in range(1, waves + 1)]
    flags = ("lateralite", "etudegp", "rempli_seulq11", "rempli_seulq12")
    kept = df.where(~F.coalesce(F.col("aexclure") == 1, F.lit(False)))
    birth = F.when(F.col("birth_year").isNotNull() & F.col("birth_month").between(1, 12), F.make_date("birth_year", "birth_month", F.lit(1)))
    out = kept.select(
        F.col("ident_projet").alias("id"),
        F.col("diag_park_final1_quest").alias("is_case"),
        F.when(F.col("profq2").isNull(), 9).when(F.col("profq2").startswith("ENE"), 1).otherwise(0).alias("profq2"),
        *(F.coalesce(F.col(c).cast("int"), F.lit(9)).alias(c) for c in flags),
        birth.alias("birth_date"),
        day(F.col("date_suivi_diag1_quest")).alias("exit_date"),
        *(day(F.col(c)).alias(c) for c in dates),
    )
    age = years(F.col("birth_date"), F.col("dateq1"))
    return out.withColumns({"age_at_entry": age, "age_at_entry_int": F.bround(age).cast("int")})


def wave_dates(recoded: DataFrame, waves: int = WAVES) -> DataFrame:
    """`id, q, filled_on` of the waves with a date."""
    cells = [F.struct(F.lit(q).alias("q"), F.col(f"dateq{q}").alias("filled_on")) for q in range(1, waves + 1)]
    return recoded.select("id", F.inline(F.array(*cells))).where("filled_on IS NOT NULL")


def wave_summary(dates: DataFrame) -> DataFrame:
    """Per wave: subjects, first and last date."""
    return dates.groupBy("q").agg(F.count("*").alias("n"), F.min("filled_on").alias("first_on"), F.max("filled_on").alias("last_on"))


def entry_quartiles(recoded: DataFrame) -> DataFrame:
    """Subjects up to the first and from the last quartile of the first wave's dates, with their years of follow-up."""
    days = F.datediff(F.col("dateq1"), F.lit("1970-01-01").cast("date"))
    cuts = recoded.where("dateq1 IS NOT NULL").agg(F.percentile(days, 0.25).alias("low"), F.percentile(days, 0.75).alias("high"))
    part = F.when(days <= F.col("low"), "first").when(days >= F.col("high"), "last")
    rows = recoded.where("dateq1 IS NOT NULL").join(F.broadcast(cuts)).withColumn("quartile", part).where("quartile IS NOT NULL")
    return rows.groupBy("quartile").agg(F.count("*").alias("n_subjects"), F.min("dateq1").alias("first_on"), F.max("dateq1").alias("last_on"), F.round(F.avg(years(F.col("dateq1"), F.col("exit_date"))), 6).alias("mean_years"))


def availability(base: DataFrame, facts: dict[str, DataFrame], waves: int = WAVES) -> DataFrame:
    """Wide flags `q{n}_{fact}`, one row per id of the base; facts are frames of `id, q`. Ids outside the base are left out.

    All facts go through one pivot: a union, a conditional aggregation that combines before its shuffle, and one join.
    """
    tagged = reduce(DataFrame.unionByName, (f.select("id", "q", F.lit(name).alias("fact")) for name, f in facts.items()))
    flags = [F.max(F.when((F.col("fact") == name) & (F.col("q") == q), 1).otherwise(0)).alias(f"q{q}_{name}") for q in range(1, waves + 1) for name in facts]
    wide = tagged.where("id IS NOT NULL AND q IS NOT NULL").groupBy("id").agg(*flags)
    names = [c for c in wide.columns if c != "id"]
    return base.select("id").where("id IS NOT NULL").distinct().join(wide, "id", "left").select("id", *(F.coalesce(c, F.lit(0)).alias(c) for c in names))


def pattern(fact: str, waves: int = WAVES) -> Column:
    """The flags of a fact as a text of 0 and 1."""
    return F.concat(*(F.col(f"q{q}_{fact}").cast("string") for q in range(1, waves + 1)))


def mask(text: Column, waves: int = WAVES) -> Column:
    """A pattern as bits, the first wave lowest."""
    return F.conv(F.reverse(F.substring(text, 1, waves)), 2, 10).cast("long")


def ordering_code(warning: Column) -> Column:
    """0 for the first stage, 1 for the second, 3 for the OCR stage, 2 for anything else, null included."""
    return F.when(warning.contains("OCR"), 3).when(warning == "First stage", 0).when(warning == "Second stage", 1).otherwise(2)


def status(base: DataFrame, runs: DataFrame) -> DataFrame:
    """Per id and wave of the runs of base ids: the highest ordering code, and whether a warning is large; -1 for ids without runs.

    Later codes override earlier ones and codes ascend, so their maximum is the override.
    """
    coded = runs.groupBy("id", "q").agg(F.max(ordering_code(F.col("warning_ordering"))).alias("ordering_code"), F.max(F.when(F.col("warning_censoring").contains("large"), 1).otherwise(0)).alias("large_warning"))
    joined = base.select("id").where("id IS NOT NULL").distinct().join(coded.where("id IS NOT NULL"), "id", "left")
    return joined.select("id", "q", F.coalesce("ordering_code", F.lit(-1)).alias("ordering_code"), F.coalesce("large_warning", F.lit(-1)).alias("large_warning"))


def first_values(base: DataFrame, facts: DataFrame, columns: list[str], order: str) -> DataFrame:
    """The values of each id's first fact; -1 where there is none, or it is null."""
    first = facts.groupBy("id").agg(*(F.min_by(c, order).alias(c) for c in columns))
    return base.select("id").where("id IS NOT NULL").distinct().join(first, "id", "left").select("id", *(F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c) for c in columns))


def drop_empty(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value in any of the columns."""
    return df.dropna(how="all", subset=columns)


def flag_conflicts(wide: DataFrame, pairs: list[tuple[str, str]], waves: int = WAVES) -> DataFrame:
    """Per wave and pair (have, lack): ids with the one flag and without the other, and the least such id."""
    cells = [F.struct(F.lit(q).alias("q"), F.lit(f"{a} without {b}").alias("conflict"), ((F.col(f"q{q}_{a}") == 1) & (F.col(f"q{q}_{b}") == 0)).alias("hit")) for q in range(1, waves + 1) for a, b in pairs]
    return wide.select("id", F.inline(F.array(*cells))).groupBy("q", "conflict").agg(F.count_if("hit").alias("n_ids"), F.min(F.when(F.col("hit"), F.col("id"))).alias("example"))


def answer_shares(recoded: DataFrame, columns: list[str]) -> DataFrame:
    """Per column and group (all, cases): each answer's number, and its share of those other than 9."""
    cells = [F.struct(F.lit(c).alias("question"), F.lit(g).alias("members"), F.when(F.lit(g == "all") | (F.col("is_case") == 1), F.col(c)).alias("answer")) for c in columns for g in ("all", "cases")]
    counts = recoded.select(F.inline(F.array(*cells))).where("answer IS NOT NULL").groupBy("question", "members", "answer").agg(F.count("*").alias("n"))
    known = counts.groupBy("question", "members").agg(F.sum(F.when(F.col("answer") != 9, F.col("n"))).alias("known"))
    return counts.join(F.broadcast(known), ["question", "members"]).select("question", "members", "answer", "n", F.when(F.col("answer") != 9, F.try_divide("n", "known")).alias("share"))
