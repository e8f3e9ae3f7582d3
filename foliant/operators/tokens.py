"""Ids read from the tokens that a recogniser found on a page: rows `page, pos, text, conf, left, top, width, height`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A number printed on every form, which is no id.
DECOY = "1234567"


def numeric(tokens: DataFrame, least: int = 50) -> DataFrame:
    """Tokens of digits alone with a confidence above the least, cut to a whole number, and their boxes."""
    return tokens.where(F.col("text").rlike("^[0-9]+$") & (F.col("conf").cast("int") > least)).withColumns({"right": F.col("left") + F.col("width"), "bottom": F.col("top") + F.col("height")})


def special_ids(tokens: DataFrame, page: str = "page", decoy: str = DECOY, least: int = 50) -> DataFrame:
    """`page, id`: the first token of six digits that has a single digit to its right, with the nearest such digit; else the
    first token of seven digits other than the decoy. Pages without either are left out.

    Only tokens with a confidence above `least` count. Distance goes from the middle of the right side to the middle of the left side; ties go by position.
    """
    t = numeric(tokens, least)
    middle = F.col("top") + F.col("height") / 2
    six = t.where(F.length("text") == 6).select(page, F.col("pos").alias("p6"), F.col("text").alias("t6"), (F.col("left") + F.col("width")).alias("x6"), middle.alias("y6"))
    one = t.where(F.length("text") == 1).select(page, F.col("pos").alias("p1"), F.col("text").alias("t1"), F.col("left").alias("x1"), middle.alias("y1"))
    pairs = six.join(one, page).where(F.col("x1") >= F.col("x6"))
    away = F.hypot(F.col("x1") - F.col("x6"), F.col("y1") - F.col("y6"))
    joined = pairs.groupBy(page).agg(F.min_by(F.concat("t6", "t1"), F.struct("p6", away.alias("d"), "p1")).alias("pair"))
    seven = t.where((F.length("text") == 7) & (F.col("text") != decoy)).groupBy(page).agg(F.min_by("text", "pos").alias("seven"))
    return joined.join(seven, page, "full").select(page, F.coalesce("pair", "seven").alias("id"))
