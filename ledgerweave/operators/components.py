"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.session import cut


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``(node, component)``; the component is the smallest node of it.

    Alternating large-star and small-star steps, each a grouping by node: the number of rounds grows with
    the logarithm of the graph, and no node's neighbours are gathered in one task (neighbourhood minima are
    partial aggregates and are joined back). Lineage is cut each round in the shared checkpoint folder.
    Null ends and loops count for nothing; repeated edges count once; no edges give no rows.
    If the links still change in the last of the rounds, that is an error.
    """
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u <> v").distinct()
    links = cut(links)
    signature = None
    for _ in range(rounds):
        both = links.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("x")).select("x.*")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(lowest, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        links = cut(small.filter("u <> v").distinct())
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == signature:
            break
        signature = now
    else:
        raise RuntimeError(f"components have not settled in {rounds} rounds")
    pair = lambda n: F.struct(F.col(n).alias("node"), F.col("v").alias("component"))
    return links.select(F.explode(F.array(pair("u"), pair("v"))).alias("x")).select("x.*").distinct()
