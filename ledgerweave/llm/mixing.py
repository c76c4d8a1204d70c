"""Mixing sources to target shares (problem 7).

Each source gets a budget of ``target_share`` of the tokens of all documents. The budget is met by
subset-sum fitting on the histogram of exact token lengths: whole repeats of the source first, then the
same fraction of every length, then a bounded-knapsack over the counts that are left for what remains.
Documents of a length are chosen by a seeded order.

Defined cases: null and empty texts have no tokens and are never chosen; a source without a target is
not used; a target without documents gets budget but reaches 0 tokens; a source whose documents, all
repeated ``max_repeats`` times, stay under the budget is used whole; a null source is no source; equal
texts in different rows are different documents; a source named twice in the targets counts once, with
the largest share and repeats; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.llm.tokens import RANK_FILE, count_of
from ledgerweave.operators.joins import salted_join
from ledgerweave.session import cut

#: The rest of a budget that the knapsack is left with, in multiples of the longest document: more where less does not meet the budget.
REST = (4, 64, 1024, 1 << 40)
#: Most sums that the knapsack keeps; rests up to this are fitted exactly.
SUMS = 1 << 24
#: A (source, length) group is cut by hash into so many parts, of which at most one is ranked.
PARTS = 4096


def fit(lengths: list[int], counts: list[int], budget: int, max_repeats: int) -> tuple[int, list[int]]:
    """Whole repeats of everything, and for each length how many documents are used once more.

    The total is the budget if a sum of lengths can meet it, else the closest sum below that the fit finds; what is left after whole repeats
    is fitted exactly up to ``SUMS`` tokens.
    """
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    if total == 0 or budget <= 0 or max_repeats <= 0:
        return 0, [0] * len(lengths)
    whole = budget // total
    if whole >= max_repeats:
        return max_repeats, [0] * len(lengths)
    rest = budget - whole * total
    longest = max(lengths)
    for share in REST:
        spared = min(rest, max(share * longest, 0), SUMS)
        extra, gap = _fitted(lengths, counts, rest, total, spared)
        if gap == 0 or spared in (rest, SUMS):
            break
    return whole, extra


def _fitted(lengths: list[int], counts: list[int], rest: int, total: int, spared: int) -> tuple[list[int], int]:
    """Documents of each length whose sum is ``rest`` or the greatest below it that is found, and what it lacks.

    All but ``spared`` is taken as the same fraction of every length; the knapsack over the counts that are left has the remainder, and is exact for it.
    """
    extra = [c * (rest - spared) // total for c in counts]
    rest -= sum(n * k for n, k in zip(lengths, extra, strict=True))
    # what rounding down left over: longest documents first, until the knapsack's part is small
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for i in order:
        if rest <= spared:
            break
        k = min(counts[i] - extra[i], (rest - spared) // lengths[i])
        extra[i] += k
        rest -= k * lengths[i]
    # bounded knapsack: of each sum the first pack that made it; packs are powers of two of one length
    reached, first, packs = np.zeros(rest + 1, dtype=bool), np.full(rest + 1, -1, dtype=np.int32), []
    reached[0] = True
    for i in order:
        left, k = min(counts[i] - extra[i], rest // lengths[i]), 1
        while left > 0 and not reached[rest]:
            k = min(k, left)
            w = k * lengths[i]
            new = np.flatnonzero(reached[: rest + 1 - w] & ~reached[w:]) + w
            first[new] = len(packs)
            reached[new] = True
            packs.append((i, k))
            left -= k
            k *= 2
    at = int(np.flatnonzero(reached)[-1])
    gap = rest - at
    while at:
        i, k = packs[first[at]]
        extra[i] += k
        at -= k * lengths[i]
    return extra, gap


def _plan(histogram: pd.DataFrame) -> pd.DataFrame:
    h = histogram.sort_values("n").reset_index(drop=True)
    whole, extra = fit(h.n.tolist(), h["c"].tolist(), int(h.budget[0]), int(h.max_repeats[0]))
    return pd.DataFrame({"source": h.source, "n": h.n, "whole": whole, "extra": extra})


def counted(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", rank_file: str = RANK_FILE) -> DataFrame:
    """``(key, source, n)``: each text is encoded once; the numbers are kept for the steps after it."""
    rows = documents.select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(text).alias("_t"))
    return cut(rows.select("key", "source", count_of(documents.sparkSession, F.col("_t"), rank_file).alias("n")))


def budgets(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, target_share, max_repeats, budget, total)``; ``total`` is the tokens of all documents."""
    goal = targets.filter("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))  # one row
    return goal.crossJoin(F.broadcast(total)).select("source", "target_share", "max_repeats", F.round(F.col("target_share") * F.col("total")).cast("long").alias("budget"), "total")


def choose(rows: DataFrame, targets: DataFrame, seed: int = 17) -> DataFrame:
    """``(key, source, n, times)`` of the documents that are used."""
    usable = rows.filter("n > 0 and source is not null")
    histogram = usable.groupBy("source", "n").agg(F.count(F.lit(1)).alias("c"))
    plan = histogram.join(F.broadcast(budgets(rows, targets)), "source").groupBy("source").applyInPandas(_plan, "source string, n long, whole long, extra long").filter("whole > 0 or extra > 0")
    # the seeded order of a length is by hash, then key; its parts are counted first, so that only the
    # part in which the count is reached is ranked
    keyed = usable.withColumn("_h", F.xxhash64(F.lit(seed), "key")).withColumn("_part", F.pmod("_h", F.lit(PARTS)))
    keyed = salted_join(keyed, cut(plan), ["source", "n"])  # a common length is no single task
    before = F.sum("_c").over(Window.partitionBy("source", "n").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = keyed.filter("extra > 0").groupBy("source", "n", "_part").agg(F.count(F.lit(1)).alias("_c")).withColumn("_before", F.coalesce(before, F.lit(0)))
    keyed = keyed.join(parts, ["source", "n", "_part"], "left").withColumn(
        "_state", F.when(F.col("_c").isNull() | (F.col("_before") >= F.col("extra")), 0).when(F.col("_before") + F.col("_c") <= F.col("extra"), 1).otherwise(2)
    )
    rank = F.row_number().over(Window.partitionBy("source", "n", "_part").orderBy("_h", "key"))
    edge = keyed.filter("_state = 2").withColumn("_more", (rank + F.col("_before") <= F.col("extra")).cast("int"))
    rest = keyed.filter("_state < 2").withColumn("_more", F.col("_state"))
    return rest.unionByName(edge).select("key", "source", "n", (F.col("whole") + F.col("_more")).alias("times")).filter("times > 0")


def shares(rows: DataFrame, chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """Report per source: budget, tokens reached, and their share of the mixture and of all tokens."""
    used = chosen.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("n") * F.col("times")).alias("tokens"), F.max("times").alias("most_repeats"))
    report = budgets(rows, targets).join(used, "source", "left")
    all_tokens = F.sum(F.coalesce("tokens", F.lit(0))).over(Window.partitionBy())  # as many rows as there are targets
    return report.select(
        "source",
        "target_share",
        F.col("budget").alias("budget_tokens"),
        F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
        F.round(F.coalesce("tokens", F.lit(0)) / F.nullif(all_tokens, F.lit(0)), 6).alias("share_reached"),
        F.round(F.coalesce("tokens", F.lit(0)) / F.nullif(F.col("total"), F.lit(0)), 6).alias("share_of_all"),
        (F.col("budget") - F.coalesce("tokens", F.lit(0))).alias("short_by"),
    )
