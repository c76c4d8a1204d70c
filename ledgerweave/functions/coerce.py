"""Total coercions of text: they give null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _extract(c: Column, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(c.cast("string"), pattern, group), F.lit(""))


def first_int(c: Column) -> Column:
    """First integer anywhere in the text."""
    return _extract(c, r"-?\d+").try_cast("long")


def strict_int(c: Column, default: int = 0) -> Column:
    """The whole text as an integer, else the default."""
    return F.coalesce(F.trim(c).try_cast("int"), F.lit(default))


def year_of(c: Column) -> Column:
    """First year of 19xx or 20xx that stands as a word, else the first integer."""
    return F.coalesce(_extract(c, r"\b((?:19|20)\d{2})\b", 1).try_cast("long"), first_int(c))


def first_float(c: Column) -> Column:
    """First number anywhere in the text, thousands separators dropped."""
    return _extract(F.replace(c.cast("string"), F.lit(","), F.lit("")), r"-?\d+(?:\.\d+)?").try_cast("double")


def strict_float(c: Column) -> Column:
    """The whole text as a number, thousands separators dropped."""
    return F.replace(F.trim(c), F.lit(","), F.lit("")).try_cast("double")


def money(c: Column) -> Column:
    """Amount with an optional magnitude: billion or bn, million or m, thousand or k.

    The first number counts, signs and brackets around it do not. A magnitude of one or two letters must be a word of its own,
    so that ``$5m`` is 5 and ``$5 m`` is 5,000,000.
    """
    bare = F.trim(F.regexp_replace(F.lower(c), r"[$,()]", ""))
    word = lambda long, short: bare.contains(long) | bare.rlike(rf"\b{short}\b")
    return first_float(bare) * F.when(word("billion", "bn"), 1e9).when(word("million", "m"), 1e6).when(word("thousand", "k"), 1e3).otherwise(1.0)


def months(c: Column) -> Column:
    """Duration in months; years count twelve."""
    n = first_float(c)
    return F.when(F.lower(c).rlike(r"(?:years?|yrs?)\b"), n * 12).when(F.lower(c).rlike(r"(?:months?|mos?)\b"), n)


def date_key(c: Column) -> Column:
    """``yyyy-mm-dd`` as the integer yyyymmdd; 0 for anything else."""
    return F.coalesce(F.regexp_replace(_extract(c, r"^\d{4}-\d{2}-\d{2}"), "-", "").try_cast("int"), F.lit(0))
