"""Sections and project rows of annual reports whose pages are given as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.functions.text import clean_name, norm_text, repaired
from ledgerweave.operators.rank import first_per_key
from ledgerweave.operators.textmine import first_of

#: The word that reports write before a number or a status; one misreading of it. Fixed values.
_PROJECT = r"pro(?:ject|iect)"
ONGOING = rf"(?i){_PROJECT}\s+is\s+ongoing|ongoing\s+{_PROJECT}|{_PROJECT}\s+ongoing"
COMPLETE = rf"(?i){_PROJECT}\s+is\s+complete|{_PROJECT}\s+completed?|completed?\s+{_PROJECT}"
#: Lines at which the name of a project is over. Fixed values.
SENTINEL = r"(?im)^\s*(?:(?:private|public) investment undertaken|ratio of private/public investment|page\s+[23]\s*$)"
NONE_SAID = r"(?i)no\s+projects\s+were\s+undertaken"
STOPS = ("General Notes", "Attachment B", "CERTIFICATION")


def from_anchor(text: Column, anchor: str, stops: Sequence[str]) -> Column:
    """The text before the earliest stop word at or after the first anchor (after the beginning where there is no anchor)."""
    start = F.greatest(F.regexp_instr(text, F.lit(anchor)), F.lit(1))
    at = F.least(*[F.nullif(F.position(F.lit(s), text, start), F.lit(0)) for s in stops], F.lit(None).cast("int"))
    return F.when(at.isNull(), text).otherwise(F.substring(text, F.lit(1), at - 1))


def section_window(pages: DataFrame, keys: Sequence[str], page: str, text: str, anchor: str, stop: str, goes_on: str, most: int) -> DataFrame:
    """Pages of a section: the first page with the anchor and up to ``most - 1`` after it.

    The section ends before a later page with a stop, and with the first later page that does not say that it goes on.
    """
    first = pages.filter(F.col(text).rlike(anchor)).groupBy(*keys).agg(F.min(page).alias("section_start"))
    near = pages.join(first, list(keys)).filter((F.col(page) >= F.col("section_start")) & (F.col(page) < F.col("section_start") + most))
    later = F.col(page) > F.col("section_start")
    order = Window.partitionBy(*keys).orderBy(page)
    stopped = F.max((later & F.col(text).rlike(stop)).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    ended = F.max((later & ~F.col(text).rlike(goes_on)).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return near.withColumn("_s", stopped).withColumn("_e", F.coalesce(ended, F.lit(0))).filter("_s = 0 and _e = 0").drop("_s", "_e")


def project_rows(reports: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """``(keys, project_number, project_name, status)`` of report texts.

    Passages begin with ``Project N:``. The name is what stands before a status or a sentinel line; without a status, a passage
    that says ongoing anywhere is active, another unknown. A report without passages that does not say that there are no projects is read
    line by line: lines with a status are projects, numbered in order. Rows of one number and name count once.
    """
    # exploding an array of one keeps the clean-up from being copied into every condition after it
    whole = reports.select(*keys, F.explode(F.array(repaired(F.col(text)))).alias("_r"))
    whole = whole.select(*keys, F.explode(F.array(from_anchor(F.col("_r"), r"(?i)Project\s+\d{1,3}\s*:", STOPS))).alias("_t"))
    mark, said = r"(?i)\bproject\s+(\d{1,3})\s*:", f"{ONGOING}|{COMPLETE[4:]}"
    numbers = F.regexp_extract_all("_t", F.lit(mark), F.lit(1))
    pieces = F.slice(F.split("_t", r"(?i)\bproject\s+\d{1,3}\s*:", -1), F.lit(2), F.size(numbers))

    def passage(number: Column, piece: Column) -> Column:
        body = F.element_at(F.split(piece, SENTINEL, 2), 1)
        status = F.when(body.rlike(ONGOING), "Active Project").when(body.rlike(COMPLETE), "Completed Project").when(piece.rlike("(?i)ongoing"), "Active Project").otherwise("Unknown")
        return F.struct(number.cast("int").alias("project_number"), clean_name(F.element_at(F.split(body, said, 2), 1), " -:;").alias("project_name"), status.alias("status"))

    def line(x: Column) -> Column:
        return F.struct(clean_name(F.element_at(F.split(x, said, 2), 1)).alias("project_name"), F.when(x.rlike("(?i)ongoing"), "Active Project").otherwise("Completed Project").alias("status"))

    # texts are read inside the arrays, so that what follows works on plain columns
    named = whole.select(*keys, F.posexplode(F.zip_with(numbers, pieces, passage)).alias("_o", "_x")).select(*keys, "_o", "_x.*").filter((F.col("project_name") != "") & (F.lower("project_name") != "see instructions"))
    # reports without passages
    bare = whole.filter(~F.col("_t").rlike(mark) & ~F.col("_t").rlike(NONE_SAID))
    read = bare.select(*keys, F.posexplode(F.transform(F.filter(F.split("_t", "\n"), lambda x: x.rlike(said)), line)).alias("_o", "_x")).select(*keys, "_o", "_x.*").filter("project_name <> ''")
    read = renumbered(read, keys, ["_o"], "project_number")
    both = named.unionByName(read).withColumn("_form", norm_text(F.col("project_name")))
    return first_per_key(both, [*keys, "project_number", "_form"], [F.asc("_o")]).select(*keys, "project_number", "project_name", "status")


def renumbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Rows of a key numbered from 1 in order."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def agreement_kind(name: Column, kinds: Sequence[tuple[str, str]], default: str) -> Column:
    """Kind of an agreement by the wording of its normal form."""
    return first_of(F.concat(F.lit(" "), norm_text(name), F.lit(" ")), kinds, default)


def reported_total(text: Column, patterns: Sequence[str]) -> Column:
    """The number of projects that a report itself states."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")).try_cast("int") for p in patterns])
