"""Names, amounts, labels and candidate rows in texts of proceedings; wording is always an argument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions.coerce import money
from ledgerweave.functions.text import clean_space, norm_text, unique_join
from ledgerweave.operators.rank import best_row, clusters
from ledgerweave.operators.textmine import largest_near

#: An amount in dollars. Fixed value.
DOLLARS = r"(?i)\$\s*\d[\d,]*(?:\.\d+)?(?:\s*(?:million|billion))?"


def captured(text: Column, patterns: Sequence[str], group: int = 1) -> Column:
    """Everything that a group of several patterns captures, pattern by pattern."""
    return F.concat(*[F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(p), F.lit(group)) for p in patterns])


def found(text: Column, patterns: Sequence[str], group: int = 1, most: int | None = None) -> Column:
    """What patterns capture, white space collapsed, those of one normal form once, joined."""
    return unique_join(F.transform(captured(text, patterns, group), clean), most=most)


def clean(name: Column, _: Column | None = None) -> Column:
    """A captured name in one line, without article before it and signs around it."""
    return F.btrim(F.regexp_replace(clean_space(name), "(?i)^(?:the|an|a) ", ""), F.lit(" ,.;:-"))


def place_name(name: Column, heads: Sequence[str], tails: Sequence[str], stop: Sequence[str], bad: str, most_words: int = 10, most_chars: int = 100, titled: float = 0.8) -> Column:
    """A captured place name cut down to itself, or null if what is left is none.

    ``heads`` are patterns stripped from the beginning one after the other, ``tails`` those from which on the rest is cut. Not a name is what is a
    stop word, matches ``bad``, is too short or long, or is not mostly set in capitals.
    """
    out = F.regexp_replace(clean_space(name), "^[^A-Za-z0-9]+", "")
    for head in heads:
        out = F.regexp_replace(out, f"(?i)^(?:{head})\\s+", "")
    for tail in tails:
        out = F.regexp_replace(out, f"(?i)\\b(?:{tail})\\b.*$", "")
    out = F.btrim(clean_space(out), F.lit(" .,:;-'\"()[]{}"))
    key = norm_text(out)
    words = F.filter(F.regexp_extract_all(out, F.lit("[A-Za-z]+"), F.lit(0)), lambda w: ~F.lower(w).isin("st", "nd", "rd", "th"))
    capital = F.filter(words, lambda w: w.rlike("^[A-Z]") | w.isin("and", "of", "the", "at", "in", "on"))
    long_enough = (F.size(F.split(key, " ")) > 1) | (F.length(key) >= 6) | out.rlike(r"\d|[/&-]")
    fits = (F.length(key) >= 3) & ~key.isin(*stop) & ~out.rlike(bad) & (F.size(capital) >= titled * F.size(words)) & long_enough & (F.size(F.split(key, " ")) <= most_words) & (F.length(out) <= most_chars)
    return F.when(fits, out)


def place_names(text: Column, terms: str, patterns: Sequence[str], **rules: object) -> Column:
    """Place names in lines that hold one of the terms, each read together with the line after it; an array, those of one normal form once."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), lambda x: clean_space(x))
    units = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(terms), F.concat_ws(" ", x, F.get(lines, i + 1)))), lambda x: x.isNotNull())
    named = F.array_compact(F.transform(captured(F.array_join(units, "\n"), patterns), lambda n: place_name(n, **rules)))
    keys = F.transform(named, norm_text)
    return F.filter(named, lambda n, i: F.array_position(keys, norm_text(n)) == i + 1)


def funding(text: Column, limit: str, context: str, radius: int) -> Column:
    """The largest of the amounts that a limiting phrase stands before, and those with a funding word near."""
    limits = F.array_max(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?i){limit}\\s+({DOLLARS[4:]})"), F.lit(1)), money))
    return F.greatest(limits, largest_near(text, DOLLARS, context, radius))


def context(text: Column, patterns: Sequence[str], radius: int) -> Column:
    """The text around the first match of the first pattern that matches, with dots where it is cut; empty if none does."""
    out = F.lit("")
    for pattern in reversed(list(patterns)):
        at = F.regexp_instr(text, F.lit(pattern))
        end = at + F.length(F.regexp_extract(text, pattern, 0))
        start = F.greatest(at - radius, F.lit(1))
        piece = F.substring(text, start, end + radius - start)
        out = F.when(at > 0, clean_space(F.concat(F.when(start > 1, "... ").otherwise(""), piece, F.when(end + radius <= F.length(text), " ...").otherwise("")))).otherwise(out)
    return F.when(text.isNotNull(), out)


def candidates(pages: DataFrame, keys: Sequence[str], page: str, text: str, hit: str, pad: int, patterns: Sequence[tuple[str, str]], ladder: Sequence[tuple[str, str]], default: str, ident: Column) -> DataFrame:
    """Candidate rows of documents: pages with a hit, clustered with their neighbours, the text of each cluster, its labels and priority.

    ``pages`` has one row per ``(keys, page)``. Result: ``(keys, candidate_id, cluster_start, cluster_end, hits, window_text, labels, priority)``, the id being
    ``ident`` and the pages. Page windows meet the pages through an equi-join.
    """
    from ledgerweave.operators.joins import window_text
    from ledgerweave.operators.textmine import first_of, tags

    windows = clusters(pages.filter(F.col(text).rlike(hit)), keys, page, pad)
    texts = window_text(windows, pages, keys, "cluster_start", "cluster_end", page, text)
    named = F.concat(ident, F.lit("-p"), F.lpad(F.col("cluster_start").cast("string"), 4, "0"), F.lit("-"), F.lpad(F.col("cluster_end").cast("string"), 4, "0"))
    labels = F.array_join(tags(F.col("window_text"), dict(patterns)), "; ")
    return texts.select(*keys, named.alias("candidate_id"), "cluster_start", "cluster_end", "hits", "window_text", labels.alias("labels"), first_of(F.col("window_text"), ladder, default).alias("priority"))


def district_rows(known: DataFrame, extracted: DataFrame, key: str, number: str, name: str) -> DataFrame:
    """``(key, number, name, origin)``: known places of a text, else the names read from it; one row per text and normal form.

    ``known`` has ``(key, number, name)``, ``extracted`` ``(key, name)``.
    """
    fallback = extracted.join(known.select(key).distinct(), key, "left_anti")
    both = known.select(key, number, name, F.lit("known").alias("origin")).unionByName(fallback.select(key, F.lit(None).cast(known.schema[number].dataType).alias(number), name, F.lit("read").alias("origin")))
    formed = both.withColumn("_form", norm_text(F.col(name))).withColumn("_first", F.struct(F.col(number).isNull().cast("int").alias("n"), F.col(name).alias("x"), F.col(number).alias("k")))
    first = formed.groupBy(key, "_form").agg(F.min(F.struct("_first", "origin")).alias("b"))
    return first.select(key, F.col("b._first.k").alias(number), F.col("b._first.x").alias(name), F.col("b.origin").alias("origin"))


def confirmed(df: DataFrame, status: str, accepted: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows that a reviewer has confirmed, as a timeline of the given columns."""
    return df.filter(F.lower(F.trim(status)).isin(*accepted)).select(*columns)


def earliest_and_largest(df: DataFrame, key: str, when: str, amount: str, ident: str) -> DataFrame:
    """Per key: rows, the earliest one, and the earliest of the largest amount; rows without a date count but are never the earliest."""
    first = best_row(df.filter(F.col(when).isNotNull()).withColumn("_o", -F.unix_date(F.col(when).try_cast("date"))), [key], ["_o", ident], [when, ident]).withColumnRenamed(ident, "earliest")
    most = df.filter(F.col(amount).isNotNull()).groupBy(key).agg(F.max(amount).alias("largest_amount"))
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).join(first, key, "left").join(most, key, "left")
