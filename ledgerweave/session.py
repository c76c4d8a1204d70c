"""Session helpers: session for local use, and lineage cuts that survive lost executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, name: str = "ledgerweave", **conf: str) -> SparkSession:
    """A session on this machine, for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    defaults = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder that the cluster shares (``spark.checkpoint.dir``).

    Only where that setting is absent and the session is local (tests on one machine) a temporary folder is set; on a
    cluster its absence is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="ledgerweave-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Rows over as many partitions as the session shuffles into.

    Distinct keys are few bytes, so the adaptive planner would put them into one task; where Python works on each of
    them, that task would be the whole query.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
