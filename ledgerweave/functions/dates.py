"""Dates typed in several layouts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
#: Layouts and how each becomes year-month-day; a time after the date is dropped.
_TIME = r"(?:[t ]\d{1,2}:\d\d.*)?$"
_LAYOUTS = (
    (r"^(\d{4})(\d\d)(\d\d)$", "$1-$2-$3"),
    (r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})" + _TIME, "$1-$2-$3"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})" + _TIME, "$3-$1-$2"),
    (r"^([a-z]{3})[a-z]{0,6}\.? (\d{1,2}),? (\d{4})$", "$3-$1-$2"),
    (r"^(\d{1,2})[- ]([a-z]{3})[a-z]{0,6}[- ,]+(\d{4})$", "$3-$2-$1"),
)


def parse_date(c: Column) -> Column:
    """The date that a text denotes, else null (blank, placeholder, impossible day).

    Layouts: ``yyyy-mm-dd`` and ``yyyymmdd`` with or without a time, ``m/d/yyyy`` (month first),
    ``Month d, yyyy``, ``d-MON-yyyy`` and ``d Month yyyy``; white space around is ignored.

    Each step uses the one before once, so that the generated code stays small.
    """
    s = F.lower(F.trim(F.regexp_replace(c.cast("string"), r"\s+", " ")))
    for pattern, iso in _LAYOUTS:
        s = F.regexp_replace(s, pattern, iso)
    for i, month in enumerate(_MONTHS, start=1):
        s = F.replace(s, F.lit(f"-{month}-"), F.lit(f"-{i:02d}-"))
    return F.nullif(F.regexp_extract(s, r"^\d{4}-\d{1,2}-\d{1,2}$", 0), F.lit("")).try_cast("date")
