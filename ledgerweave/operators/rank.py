"""First, last and best rows per key. DataFrames have no row order, so the order is always an argument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ascending order of the columns."""
    return first_per_key(df, keys, [F.desc_nulls_last(c) for c in order])


def best_row(df: DataFrame, keys: Sequence[str], rank: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Of each key the columns ``keep`` of the row with the greatest rank; a partial aggregate, so a hot key costs no long sort."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*keep), F.struct(*rank)).alias("_b")).select(*keys, "_b.*")


def clusters(df: DataFrame, keys: Sequence[str], hit: str, pad: int = 0, low: int | None = 1, high: str | None = None) -> DataFrame:
    """Gaps and islands of hit positions, each widened by ``pad`` and clipped: ``(keys, cluster_start, cluster_end, hits)``.

    Hits are made distinct first; neighbouring windows that touch are one cluster.
    """
    start = F.col(hit) - pad if low is None else F.greatest(F.col(hit) - pad, F.lit(low))
    end = F.col(hit) + pad if high is None else F.least(F.col(hit) + pad, F.col(high))
    rows = df.filter(F.col(hit).isNotNull()).select(*keys, F.col(hit).alias("_h"), start.alias("_s"), end.alias("_t")).distinct()
    order = Window.partitionBy(*keys).orderBy("_h")
    before = F.max("_t").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.coalesce(F.col("_s") > F.col("_before") + 1, F.lit(True)).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.withColumn("_before", before).withColumn("_i", island).groupBy(*keys, "_i").agg(F.min("_s").alias("cluster_start"), F.max("_t").alias("cluster_end"), F.count(F.lit(1)).alias("hits")).drop("_i")
    )


def carry_forward(df: DataFrame, keys: Sequence[str], position: str, value: Column, name: str) -> DataFrame:
    """The last value that is not null at or before each row."""
    w = Window.partitionBy(*keys).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def with_next(df: DataFrame, keys: Sequence[str], position: str, text: str, below: int, name: str) -> DataFrame:
    """A short line together with the line after it."""
    after = F.lead(text).over(Window.partitionBy(*keys).orderBy(position))
    return df.withColumn(name, F.when((F.length(text) < below) & after.isNotNull(), F.concat_ws(" ", text, after)).otherwise(F.col(text)))


def stratified_sample(df: DataFrame, stratum: Column, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows by stratum, then order, each key once; all rows as they are if ``n`` is 0 or no less than their number.

    The limit is what the operator is for.
    """
    if n == 0 or df.limit(n + 1).count() <= n:
        return df.withColumn("stratum", stratum)
    once = first_per_key(df.withColumn("stratum", stratum), keys, [F.col("stratum"), *order])
    return once.orderBy("stratum", *order).limit(n)
