"""A register of entities put together from several sources, and what is missing about them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions.text import informative
from ledgerweave.operators.aggregate import weighted_vote
from ledgerweave.operators.textmine import tags


def register(evidence: DataFrame, key: str, year: str, source: str, name: str, weight: str, order: Sequence[str], implied: DataFrame, low: int, high: int) -> DataFrame:
    """One row per entity over all sources.

    ``evidence`` has ``(key, year, source, name, weight)`` rows, ``implied`` ``(key, year)`` rows from intervals. Result: the
    name with the most weight, all spellings in alphabetical order whatever their case, observed and implied first and last years within the bounds,
    the number of years seen, and the sorted sources.
    """
    from ledgerweave.functions.text import norm_text

    votes = evidence.withColumn("_form", norm_text(F.col(name))).filter("_form <> ''")
    voted = weighted_vote(votes, key, "_form", name, weight, [F.asc(o) for o in order]).drop("spellings")
    seen = F.when(F.col(year).between(low, high), F.col(year))
    spelt = F.array_sort(F.collect_set(F.struct(F.lower(F.trim(name)).alias("l"), F.trim(name).alias("n"))))
    facts = evidence.groupBy(key).agg(
        F.min(seen).alias("first_observed"), F.max(seen).alias("last_observed"), F.countDistinct(seen).alias("years_observed"), F.array_join(F.array_sort(F.collect_set(source)), "; ").alias("sources"), spelt.alias("_n")
    )
    spans = implied.groupBy(key).agg(F.min(year).alias("first_implied"), F.max(year).alias("last_implied"))
    rows = facts.join(spans, key, "full_outer").join(voted, key, "left")
    variants = F.array_join(F.transform(F.filter(F.coalesce("_n", F.array().cast("array<struct<l:string,n:string>>")), lambda x: F.coalesce(x["n"], F.lit("")) != ""), lambda x: x["n"]), "; ")
    return rows.select(
        key, F.coalesce("voted", F.lit("")).alias("canonical"), variants.alias("variants"), F.least("first_observed", "first_implied").alias("first_year"), F.greatest("last_observed", "last_implied").alias("last_year"),
        F.coalesce("years_observed", F.lit(0)).alias("years_observed"), F.coalesce("sources", F.lit("")).alias("sources"),
    )


def gaps(df: DataFrame, reasons: Mapping[str, Column], complete: str, ladder: Sequence[tuple[Column, str]], default: str) -> DataFrame:
    """Rows with the reasons why they are not complete, joined in order, and a priority from a ladder of conditions."""
    given = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(label)) for label, c in reasons.items()]))
    priority = None
    for condition, label in ladder:
        c = F.coalesce(condition, F.lit(False))
        priority = F.when(c, label) if priority is None else priority.when(c, label)
    return df.withColumn("reasons", F.when(F.size(given) == 0, complete).otherwise(F.array_join(given, " | "))).withColumn("priority", priority.otherwise(default))


def search_terms(names: Sequence[Column], generic: Sequence[str], most: int | None = None) -> Column:
    """Names that can be searched for, in order, each once."""
    kept = F.array_distinct(F.filter(F.array_compact(F.array(*names)), lambda n: informative(n, generic)))
    return F.slice(kept, 1, most) if most else kept


def flag(df: DataFrame, listed: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Whether a row's key is in a list: 1 or 0 (a semi-join that keeps all rows)."""
    return df.join(listed.select(*keys).distinct().withColumn(name, F.lit(1)), list(keys), "left").withColumn(name, F.coalesce(name, F.lit(0)))


def lookup(df: DataFrame, values: DataFrame, keys: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Left join with one row per key, each missing value replaced by its default (``None`` stays null)."""
    out = df.join(values.select(*keys, *defaults), list(keys), "left")
    for name, default in defaults.items():
        if default is not None:
            out = out.withColumn(name, F.coalesce(name, F.lit(default)))
    return out


def notes(*parts: Column, sep: str = " | ") -> Column:
    """Note of the parts that are not blank."""
    return F.concat_ws(sep, *[F.nullif(F.trim(p), F.lit("")) for p in parts])


def labelled(text: Column, patterns: Mapping[str, str], fallback: Column) -> Column:
    """Labels of the patterns that the text holds, joined; the fallback where there is none."""
    found = F.array_join(tags(F.coalesce(text, F.lit("")), patterns), "; ")
    return F.when(found == "", fallback).otherwise(found)
