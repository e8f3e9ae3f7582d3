"""Noisy text: normal forms, similarities, and numbers read from it."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType


@pandas_udf(StringType())
def compatible(s: pd.Series) -> pd.Series:
    """Unicode's compatibility form, which Spark lacks."""
    return s.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def normalize(c: Column) -> Column:
    """Lower case, without signs other than . , : ; - ( ) / %, blanks made one. Texts of ASCII stay in the JVM's hands."""
    return squeeze(F.lower(compatible(c)))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"(?U)[^\w\s.,:;\-()/%]", " "), r"(?U)\s+", " "))


def tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, r"\s+"), lambda x: x != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Shared tokens over all; 1 if both have none."""
    x, y = tokens(a), tokens(b)
    return F.when((F.size(x) == 0) & (F.size(y) == 0), 1.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def containment(a: Column, b: Column) -> Column:
    """Shared tokens over those of the smaller set; 1 if both have none, 0 if one has none."""
    x, y = tokens(a), tokens(b)
    least = F.least(F.size(x), F.size(y))
    return F.when((F.size(x) == 0) & (F.size(y) == 0), 1.0).when(least == 0, 0.0).otherwise(F.size(F.array_intersect(x, y)) / least)


@pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching blocks, twice their length over both lengths; null if either is null."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def compare(a: Column, b: Column) -> Column:
    """Both texts as they are and in normal form, with their similarities."""
    x, y = normalize(a), normalize(b)
    return F.struct(a.alias("raw_a"), b.alias("raw_b"), x.alias("norm_a"), y.alias("norm_b"), sequence_ratio(x, y).alias("sequence"), jaccard(x, y).alias("jaccard"), containment(x, y).alias("containment"))


def target_number(c: Column) -> Column:
    """Six digits and one more after blanks, without spaces; else the longest run of digits, the first of ties; else null."""
    seven = F.regexp_extract(c, r"[0-9]{6}\s*[0-9]", 0)
    runs = F.regexp_extract_all(c, F.lit(r"([0-9]+)"), 1)
    longest = F.aggregate(runs, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))
    return F.when(seven != "", F.replace(seven, F.lit(" "), F.lit(""))).when(longest != "", longest)


def crc(c: Column) -> Column:
    return F.crc32(c)


def palette_index(c: Column, n: int = 10) -> Column:
    """Sum of the code points modulo a palette's size."""
    return F.aggregate(F.transform(F.split(c, ""), lambda x: F.ascii(x)), F.lit(0), lambda a, b: a + b) % n
