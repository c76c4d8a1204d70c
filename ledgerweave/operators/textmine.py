"""Mentions, tags and sections in texts, as Column expressions over lines and pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.functions.coerce import money, months
from ledgerweave.functions.spans import matches, nearest, places
from ledgerweave.functions.text import person_name, strip_markup

#: An amount with a dollar sign and an optional magnitude, or a number with a magnitude. Fixed value.
MONEY = r"\$+\s*\(?\d[\d,]*(?:\.\d+)?\)?\s*(?:billion|million|thousand|bn|m|k)?|\b\d[\d,]*(?:\.\d+)?\s*(?:billion|million|thousand|bn|m|k)\b"
#: A number of months or years. Fixed value.
DURATION = r"\b\d+(?:\.\d+)?\s*(?:months|month|mos|mo|years|year|yrs|yr)\b"
#: Words that say an amount is planned, that it is spent, and that a text is about time. Fixed values.
PROJECTED = ("projected", "estimate", "estimated", "budget", "budgeted", "anticipated", "expected", "proposed", "planned", "target", "projection")
REALIZED = ("actual", "realized", "final", "completed", "completion", "incurred", "spent", "expenditure", "delivered")
TIME_HINTS = ("month", "months", "year", "years", "schedule", "timeline", "duration", "completion", "deadline")


def mentions(df: DataFrame, keys: Sequence[str], text: str, pattern: str, kind: str) -> DataFrame:
    """``(keys, pos, kind, value_raw, value_numeric, at)``: every match of the pattern."""
    value = money if kind == "cost" else months
    rows = df.select(*keys, F.posexplode(matches(F.col(text), f"(?i){pattern}")).alias("pos", "m"))
    return rows.select(*keys, "pos", F.lit(kind).alias("kind"), F.trim("m.hit").alias("value_raw"), value(F.col("m.hit")).alias("value_numeric"), F.col("m.at").alias("at"))


def keyword_spans(text: Column, groups: Mapping[str, Sequence[str]], ranked: bool = True) -> Column:
    """Places of every keyword (substrings, which may overlap) with its group as label; the rank is that of the group, else 0."""
    low = F.lower(text)
    found = lambda label, rank, word: F.transform(places(low, word), lambda m: F.struct(m["at"].alias("at"), m["hit"].alias("hit"), F.lit(label).alias("label"), F.lit(rank).alias("rank")))
    return F.concat(*[found(label, rank if ranked else 0, word) for rank, (label, words) in enumerate(groups.items()) for word in words])


def nearest_label(df: DataFrame, text: str, at: str, groups: Mapping[str, Sequence[str]], name: str) -> DataFrame:
    """The group of the keyword that begins nearest to a mention; earlier groups, then earlier keywords on ties; null without any keyword."""
    return df.withColumn(name, nearest(keyword_spans(F.col(text), groups), F.col(at))["label"])


def nearest_word(df: DataFrame, text: str, at: str, words: Sequence[str], name: str) -> DataFrame:
    """The keyword that begins nearest to a mention; the earlier, then the one first in the list on ties; null without any."""
    spans = F.concat(*[F.transform(places(F.lower(text), word), lambda m: F.struct(m["at"].alias("at"), m["hit"].alias("hit"))) for word in words])
    order = F.transform(spans, lambda s: F.struct(F.abs(s["at"] - F.col(at)).alias("d"), s["at"].alias("at"), F.array_position(F.array(*[F.lit(w) for w in words]), s["hit"]).alias("k"), s["hit"].alias("hit")))
    return df.withColumn(name, F.array_min(order)["hit"])


def tags(text: Column, patterns: Mapping[str, str]) -> Column:
    """Labels of the patterns that the text holds, in the order given."""
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(label)) for label, p in patterns.items()]))


def gate(text: Column, strong: str, weak: str, context: str) -> Column:
    """Whether a text is of interest at all: it holds a strong term, or a weak one together with a word of its context."""
    return F.coalesce(text.rlike(strong) | (text.rlike(weak) & text.rlike(context)), F.lit(False))


def best_snippet(text: Column, patterns: Sequence[tuple[str, int]], around: int) -> Column:
    """The text around the first match of the heaviest pattern, with dots where it is cut; the earlier match on ties; null without a match."""
    spans = F.array_compact(F.array(*[F.when(F.regexp_instr(text, F.lit(p)) > 0, F.struct(F.lit(w).alias("w"), (-F.regexp_instr(text, F.lit(p))).alias("at"))) for p, w in patterns]))
    best = F.array_max(spans)
    start = F.greatest(-best["at"] - around, F.lit(1))
    dots = lambda cut, mark: F.when(cut, mark).otherwise("")
    return F.when(F.size(spans) > 0, F.concat(dots(start > 1, "... "), F.substring(text, start, F.lit(2 * around)), dots(start + 2 * around <= F.length(text), " ...")))


def first_of(text: Column, cases: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first case whose pattern the text holds."""
    out = None
    for pattern, label in cases:
        out = F.when(text.rlike(pattern), label) if out is None else out.when(text.rlike(pattern), label)
    return out.otherwise(default)


def lines(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """``(keys, line_no, line)``: non-blank lines, white space collapsed, numbered from 0 with the blank ones counted."""
    rows = df.select(*keys, F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "line"))
    return rows.withColumn("line", F.trim(F.regexp_replace("line", r"[ \t ]+", " "))).filter("line <> ''")


def largest_near(text: Column, pattern: str, context: str, radius: int) -> Column:
    """The largest amount with a context word within the radius on either side."""
    spans = matches(text, pattern)
    near = F.filter(spans, lambda m: F.substring(text, F.greatest(m["at"] - radius + 1, F.lit(1)), F.length(m["hit"]) + 2 * radius).rlike(context))
    return F.array_max(F.transform(near, lambda m: money(m["hit"])))


def project_blocks(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """``(keys, project_number, block)``: passages that begin with ``Project N:``, up to the next."""
    marks = F.regexp_extract_all(F.col(text), F.lit(r"(?i)\bproject\s+(\d+)\s*:"), F.lit(1))
    pieces = F.slice(F.split(text, r"(?i)\bproject\s+\d+\s*:", -1), F.lit(2), F.size(marks))
    rows = df.select(*keys, F.explode(F.arrays_zip(marks.alias("n"), pieces.alias("b"))).alias("x"))
    return rows.select(*keys, F.col("x.n").cast("int").alias("project_number"), F.trim(F.regexp_replace("x.b", r"\s+", " ")).alias("block"))


def anchor_blocks(df: DataFrame, keys: Sequence[str], position: str, line: str, anchor: str, stop: str, most: int) -> DataFrame:
    """``(keys, block_no, block)``: each anchor line with what follows it, up to ``most`` lines in all, a stop line or the next anchor."""
    order = Window.partitionBy(*keys).orderBy(position)
    is_anchor = F.col(line).rlike(anchor)
    numbered = df.withColumn("block_no", F.sum(is_anchor.cast("int")).over(order)).filter("block_no > 0")
    inner = Window.partitionBy(*keys, "block_no").orderBy(position)
    stopped = F.sum((F.col(line).rlike(stop) & ~is_anchor).cast("int")).over(inner)
    kept = numbered.withColumn("_r", F.row_number().over(inner)).withColumn("_s", stopped).filter((F.col("_r") <= most) & (F.col("_s") == 0))
    return kept.groupBy(*keys, "block_no").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(position, line))), lambda x: x[line]), " ").alias("block"))


def section_pages(pages: DataFrame, keys: Sequence[str], page: str, text: str, anchor: str, most: int) -> DataFrame:
    """Pages of the section that begins on the first page with the anchor: that page and up to ``most - 1`` after it."""
    first = pages.filter(F.col(text).rlike(anchor)).groupBy(*keys).agg(F.min(page).alias("section_start"))
    return pages.join(first, list(keys)).filter((F.col(page) >= F.col("section_start")) & (F.col(page) < F.col("section_start") + most))


def roster(lines_: DataFrame, position: str, line: str) -> DataFrame:
    """``(ward, name)`` of a wiki roster: headings ``=== Nth Ward ===``, below each ``* name`` or ``!scope="row"|name`` lines."""
    ward = F.nullif(F.regexp_extract(line, r"(?i)^=+\s*(\d+)(?:st|nd|rd|th)\s+ward\s*=+", 1), F.lit("")).try_cast("int")
    carried = lines_.withColumn("ward", F.last(ward, ignorenulls=True).over(Window.orderBy(position).rowsBetween(Window.unboundedPreceding, 0)))  # one page of at most 50 wards
    name = F.regexp_extract(line, r"^(?:\*\s*|!\s*scope=\"row\"\s*\|\s*)(.+)$", 1)
    return carried.filter((name != "") & F.col("ward").isNotNull()).select("ward", person_name(strip_markup(name)).alias("name")).distinct()
