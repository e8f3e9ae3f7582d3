"""Canonical keys of subjects and scans, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"[\s\x{00A0}\x{FEFF}]+"


def subject_key(c: Column) -> Column:
    """Digits of a subject's number without leading zeros, blanks and a spreadsheet's decimal tail; null if it can't be read."""
    digits = F.regexp_extract(F.regexp_replace(c.cast("string"), BLANKS, ""), r"^0*([0-9]+)(?:[.,]0*)?$", 1)
    return F.when(digits != "", digits)


def scan_key(c: Column) -> Column:
    """A scan's name without letter case, outer blanks and any number of .pdf and .tif endings; null if nothing is left."""
    name = F.regexp_replace(F.lower(c), r"^[\s\x{00A0}\x{FEFF}]+|(?:[\s\x{00A0}\x{FEFF}]|\.pdf|\.tif)+$", "")
    return F.when(name != "", name)
