"""Overlapping and gapped time intervals per entity (problem 5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.functions.dates import parse_date

OPEN_END = "9999-12-31"


def merge_intervals(df: DataFrame, entity: str, start: Column, end: Column) -> DataFrame:
    """Continuous periods and the gaps between them.

    Intervals are half open, ``[start, end)``; touching ones are one period. Result:
    ``(entity, kind, start_d, end_d)``, kind ``period`` or ``gap``, dates of type date, no row twice.

    Defined cases: rows with a null start or end, or an end not after the start, count for nothing;
    rows with a null entity belong to no entity and count for nothing; repeated rows and ties change
    nothing; an empty table gives an empty result; other columns are ignored, whatever their names.

    Plan: rows are first reduced to one per (entity, start) with partial aggregation, so that an entity
    that holds much of the table brings at most one row per calendar day into its window; then one
    exchange on the entity serves both windows and the grouping between them.
    """
    rows = (
        df.select(F.col(entity).alias("_e"), start.cast("date").alias("_s"), end.cast("date").alias("_t"))
        .filter("_e is not null and _s is not null and _t > _s")
        .groupBy("_e", "_s")
        .agg(F.max("_t").alias("_t"))
    )
    order = Window.partitionBy("_e").orderBy("_s")
    before = F.max("_t").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = (F.coalesce(F.col("_s") > F.col("_before"), F.lit(True))).cast("int")
    periods = (
        rows.withColumn("_before", before)
        .withColumn("_island", F.sum(opens).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("_e", "_island")
        .agg(F.min("_s").alias("_s"), F.max("_t").alias("_t"))
        .withColumn("_next", F.lead("_s").over(order))
    )
    item = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), F.col(a).alias("start_d"), F.col(b).alias("end_d"))
    both = F.array(item("period", "_s", "_t"), F.when(F.col("_next").isNotNull(), item("gap", "_t", "_next")))
    return periods.select(F.col("_e").alias(entity), F.explode(F.array_compact(both)).alias("_x")).select(entity, "_x.*")


def tract_intervals(df: DataFrame) -> DataFrame:
    """Periods and gaps of boundary tracts whose dates are text.

    An interval ends at ``repealed_d`` if that is a date, else at ``expiration`` if that is a date, else
    it is open and ends at 9999-12-31.
    """
    end = F.coalesce(parse_date(F.col("repealed_d")), parse_date(F.col("expiration")), F.lit(OPEN_END).cast("date"))
    found = merge_intervals(df, "tract_id", parse_date(F.col("approval_d")), end)
    text = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return found.select("tract_id", "kind", text("start_d"), text("end_d"))
