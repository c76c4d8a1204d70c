"""Identifiers and flags typed in several styles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def district_number(c: Column) -> Column:
    """Canonical ``T-NNN`` of a district number in any style; null where there is no digit."""
    digits = F.regexp_extract(F.upper(F.trim(c)), r"(\d{1,3})", 1)
    return F.when(digits != "", F.concat(F.lit("T-"), F.lpad(digits, 3, "0")))


def truthy(c: Column) -> Column:
    """Whether a text says yes: 1, true, yes, y or t in any case."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("1", "true", "yes", "y", "t"), F.lit(False))


def canonical_district(c: Column) -> Column:
    """``T-NNN`` where the text has a digit, else the text in upper case; null reads as empty."""
    up = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    digits = F.regexp_extract(up, r"(\d{1,3})", 1)
    return F.when(digits != "", F.concat(F.lit("T-"), F.lpad(digits, 3, "0"))).otherwise(up)
