"""Panels, roll-ups, votes, calendars and metric tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.operators.rank import first_per_key


def counts_and_sums(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], count: str = "n") -> DataFrame:
    """Rows and null-as-zero sums per key; rows with a null in a key are left out."""
    kept = df.dropna(subset=list(keys))
    return kept.groupBy(*keys).agg(F.count(F.lit(1)).alias(count), *[F.round(F.sum(F.coalesce(c, F.lit(0.0))), 2).alias(name) for name, c in sums.items()])


def conditional_sums(df: DataFrame, keys: Sequence[str], value: Column, cases: Mapping[str, Column], other: str) -> DataFrame:
    """One sum per case, and one of the rows that no case holds for."""
    taken = F.lit(False)
    out = []
    for name, when in cases.items():
        hit = F.coalesce(when, F.lit(False)) & ~taken
        out.append(F.round(F.sum(F.when(hit, F.coalesce(value, F.lit(0.0))).otherwise(0.0)), 2).alias(name))
        taken = taken | F.coalesce(when, F.lit(False))
    out.append(F.round(F.sum(F.when(~taken, F.coalesce(value, F.lit(0.0))).otherwise(0.0)), 2).alias(other))
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*out)


def metric_table(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """A one-row aggregate as a long ``(metric, value)`` table."""
    row = df.agg(*[c.cast("double").alias(name) for name, c in metrics.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(f"`{name}`").alias("value")) for name in metrics])
    return row.select(F.explode(pairs).alias("m")).select("m.*")


def counts_as_metrics(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Group counts rendered as metric names."""
    name = F.concat_ws("_", F.lit(prefix), *[F.coalesce(F.nullif(F.col(k), F.lit("")), F.lit("blank")) for k in keys])
    return df.groupBy(name.alias("metric")).agg(F.count(F.lit(1)).cast("double").alias("value"))


def weighted_vote(votes: DataFrame, key: str, form: str, name: str, weight: str, order: Sequence[Column]) -> DataFrame:
    """``(key, voted, votes, spellings)``: the name with the most weight per key.

    Names of one normal form vote together under their first spelling; ties go to the longer, then to the later in lower-cased order.
    """
    first = first_per_key(votes, [key, form], order).select(key, form, F.col(name).alias("_n"))
    weights = votes.groupBy(key, form).agg(F.sum(weight).alias("_w")).join(first, [key, form])
    return weights.groupBy(key).agg(F.max_by("_n", F.struct("_w", F.length("_n"), F.lower("_n"))).alias("voted"), F.max("_w").alias("votes"), F.count(F.lit(1)).alias("spellings"))


def expand_years(df: DataFrame, start: str, end: str, low: int, high: int, name: str = "year") -> DataFrame:
    """One row per year of an interval, clipped to the bounds; a null end is the upper bound, an end before the start gives no row."""
    s, t = F.greatest(F.col(start), F.lit(low)), F.least(F.coalesce(end, F.lit(high)), F.lit(high))
    rows = df.filter(F.col(start).isNotNull()).withColumn("_s", s.cast("int")).withColumn("_t", t.cast("int")).filter("_t >= _s")
    return rows.withColumn(name, F.explode(F.sequence("_s", "_t"))).drop("_s", "_t")


def calendar(observed: DataFrame, implied: DataFrame, key: str, year: str, source: str, sources: Sequence[str]) -> DataFrame:
    """Full outer calendar of observed and implied years with one flag per source and a coverage status."""
    a = observed.select(key, year, F.col(source).alias("_src"), F.lit(1).alias("_o"), F.lit(0).alias("_i"))
    b = implied.select(key, year, F.lit(None).cast("string").alias("_src"), F.lit(0).alias("_o"), F.lit(1).alias("_i"))
    flags = [F.max((F.coalesce("_src", F.lit("")) == s).cast("int")).alias(f"has_{s}") for s in sources]
    days = a.unionByName(b).dropna(subset=[key, year]).groupBy(key, year).agg(F.max("_o").alias("observed"), F.max("_i").alias("implied"), *flags)
    status = F.when((F.col("observed") == 1) & (F.col("implied") == 1), "observed_active").when(F.col("observed") == 1, "observed_no_date_interval").otherwise("date_implied_only")
    return days.withColumn("coverage_status", status)


def roll_up(df: DataFrame, key: str, year: str, rank: Column, label: str, variants: str, order: str) -> DataFrame:
    """Per key: first and last year, number of rows with a year, the label of the best-ranked row (first on ties), sorted variants."""
    return df.groupBy(key).agg(
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
        F.count(year).alias("years_observed"),
        F.max_by(label, F.struct(rank.alias("r"), (-F.col(order)).alias("o"))).alias("best_status"),
        F.array_join(F.array_sort(F.collect_set(F.nullif(F.col(variants), F.lit("")))), " | ").alias("variants"),
    )


def union_tagged(tables: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """UNION ALL of tables with a constant tag; columns that a table lacks are null."""
    out = None
    for name, df in tables.items():
        part = df.withColumn(tag, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
