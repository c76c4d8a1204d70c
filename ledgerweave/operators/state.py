"""Cumulative tables: keyed appends, upserts, and refreshes that keep what people decided.

Each takes the stored table and the new rows and returns what is to be stored; without a table format
there is no MERGE, so the result is written beside and swapped in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.operators.rank import first_per_key


def _key(keys: Sequence[str]) -> Column:
    return F.concat_ws("\u0001", *[F.trim(F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in keys])


def new_rows(stored: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows of the batch to append: trimmed key not all blank, not stored, first of its key in the batch."""
    blank = "\u0001" * (len(keys) - 1)
    fresh = first_per_key(batch.withColumn("_key", _key(keys)).filter(F.col("_key") != blank), ["_key"], order)
    return fresh.join(stored.select(_key(keys).alias("_key")).distinct(), "_key", "left_anti").drop("_key")


def append_unique(stored: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return stored.unionByName(new_rows(stored, batch, keys, order), allowMissingColumns=True)


def carry_first_seen(prior: DataFrame, fresh: DataFrame, keys: Sequence[str], run: Column, first: str = "first_seen_run", last: str = "last_checked_run") -> DataFrame:
    """Fresh rows with the run in which their key was first seen."""
    seen = prior.groupBy(*keys).agg(F.min(first).alias("_first"))
    return fresh.join(seen, list(keys), "left").withColumn(first, F.coalesce("_first", run)).withColumn(last, run).drop("_first")


def upsert(stored: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows with the changes written over them and new keys added; a change with a null keeps the stored value."""
    values = [c for c in stored.columns if c not in keys]
    a, b = stored.alias("a"), changes.alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    pick = lambda c: F.coalesce(f"b.{c}", f"a.{c}").alias(c)
    return a.join(b, on, "full_outer").select(*[pick(c) for c in [*keys, *values]])


def keep_reviewed(generated: DataFrame, reviewed: DataFrame, key: str, status: str, open_status: str = "needs_review") -> DataFrame:
    """A refresh that keeps reviewed rows as they are: reviewed rows stay word for word, others are made anew, and reviewed rows whose
    candidate is gone stay too."""
    decided = reviewed.filter((F.coalesce(F.trim(status), F.lit("")) != "") & (F.col(status) != open_status))
    return decided.unionByName(generated.join(decided.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def unseen(batch: DataFrame, *seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key none of the seen tables has."""
    for s in seen:
        batch = batch.join(s.select(key).distinct(), key, "left_anti")
    return batch
