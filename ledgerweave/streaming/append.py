"""Streams into cumulative tables: each batch appends the rows whose key is new.

State is the stored table itself, so a stream that is stopped goes on where it was, and a batch that is run
again appends nothing twice.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerweave.operators.state import new_rows


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    path_ = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = path_.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path_)
    return spark.read.schema(like.schema).parquet(path) if there else spark.createDataFrame([], like.schema)


#: Parts, by hash of the key, that the stored table is divided into; a batch reads the parts of its keys only.
PARTS = 64


def append_unique_stream(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[Column]) -> StreamingQuery:
    """Run what there is (``availableNow``), one keyed append per batch.

    Each batch is written to its own folder ``batch=<id>``, replaced if the batch runs again after a failure, and within it by parts of the key's hash.
    """
    part = F.pmod(F.xxhash64(*[F.trim(F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in keys]), F.lit(PARTS)).cast("int")

    def append(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("part", part)
        met = [r[0] for r in rows.select("part").distinct().collect()]  # at most PARTS numbers
        stored = _stored(spark, path, rows.withColumn("batch", F.lit(0))).filter((F.col("batch") != number) & F.col("part").isin(met)).drop("batch")
        new_rows(stored, rows, keys, order).write.mode("overwrite").partitionBy("part").parquet(os.path.join(path, f"batch={number}"))

    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, window: str, late: str, keys: Sequence[str]) -> DataFrame:
    """Counts per event-time window; rows later than the watermark are dropped by the engine."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), *keys).agg(F.count(F.lit(1)).alias("n"))


def harvest_step(fetched: DataFrame, seen: DataFrame, key: str, term_index: int, skip: int, page_size: int) -> tuple[DataFrame, dict]:
    """New rows of one fetched page, and the row that the batch log gets; ``stop`` is set when a page brings nothing new."""
    fresh = fetched.join(seen.select(key).distinct(), key, "left_anti")
    counts = fetched.select(F.count(F.lit(1)).alias("fetched")).crossJoin(fresh.select(F.count(F.lit(1)).alias("new"))).first()  # two numbers
    row = {"term_index": term_index, "next_skip": skip + max(counts["fetched"], page_size if counts["fetched"] else 0), "rows_fetched": counts["fetched"], "new_rows": counts["new"], "stop": counts["new"] == 0}
    return fresh, row
