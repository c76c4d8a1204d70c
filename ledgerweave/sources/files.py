"""File sources: loosely typed CSV, JSON records, manifests, metric maps, pages of text, binary checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strings(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop) is not None and bool(
        len(hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop))
    )


def csv_table(spark: SparkSession, path: str, columns: Sequence[str], missing_ok: bool = True) -> DataFrame:
    """All columns as text, quoted fields over several lines, a byte order mark ignored, missing values as the empty string.

    A missing file gives no rows, or an error where ``missing_ok`` is false.
    """
    schema = strings(columns)
    if not _exists(spark, path):
        if missing_ok:
            return spark.createDataFrame([], schema)
        raise FileNotFoundError(path)
    rows = spark.read.options(header=True, multiLine=True, escape='"', quote='"', enforceSchema=False).csv(path)
    rows = rows.toDF(*[c.lstrip("﻿").strip() for c in rows.columns])
    return rows.select(*[(F.col(f"`{c}`") if c in rows.columns else F.lit("")).alias(c) for c in columns]).na.fill("")


def rejects_json(first_line: Column) -> Column:
    """Whether a body that should be CSV begins like a JSON error."""
    return F.substring(first_line, 1, 120).rlike(r"^\s*\{")


def json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def exploded_attachments(records: DataFrame, keys: Sequence[str], items: str, path: str) -> DataFrame:
    """``(keys, item_index, item.*)``: items of an array of structs, those without a path dropped, the index counting all from 1."""
    rows = records.select(*keys, F.posexplode(items).alias("_i", "_x"))
    return rows.filter(F.coalesce(F.trim(F.col(f"_x.{path}")), F.lit("")) != "").select(*keys, (F.col("_i") + 1).alias("item_index"), "_x.*")


def manifest(df: DataFrame, year: str, low: int, high: int, dates: Sequence[str] | None, valid: Column, path: str, date: str, limit: int = 0) -> DataFrame:
    """Manifest rows of a year range and a list of dates, valid, one per path, in order of date and path; ``limit`` 0 keeps all."""
    rows = df.filter(F.col(year).between(low, high) & valid)
    if dates is not None:
        rows = rows.filter(F.col(date).isin(list(dates)))
    rows = rows.dropDuplicates([path]).orderBy(date, path)
    return rows.limit(limit) if limit else rows


def metric_map(df: DataFrame, order: str) -> DataFrame:
    """``(metric, value)`` with the last value of each metric."""
    return df.groupBy("metric").agg(F.max_by("value", order).alias("value"))


def seeded(spark: SparkSession, path: str, columns: Sequence[str], seed: Sequence[Mapping[str, str]]) -> DataFrame:
    """A small configuration table; its seed rows where there is no file yet."""
    if _exists(spark, path):
        return csv_table(spark, path, columns)
    return spark.createDataFrame([tuple(r.get(c, "") for c in columns) for r in seed], strings(columns))


def listed_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``(path, length, modificationTime)`` of the files below a folder; contents are not read."""
    return spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=glob).load(folder).select("path", "length", "modificationTime")


def valid_pdf(content: Column, least: int = 500) -> Column:
    """Whether bytes are a PDF: long enough and with its magic number."""
    return (F.length(content) >= least) & (F.substring(content, 1, 5) == F.lit(b"%PDF-"))


def page_text(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, page, text)`` of sidecar files ``.../<page>.txt``; the extraction itself needs tools that are not part of Spark."""
    rows = spark.read.text(folder, wholetext=True, recursiveFileLookup=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    return rows.withColumn("page", F.regexp_extract("path", r"(\d+)\.txt$", 1).try_cast("int"))


def cached_pages(cache: DataFrame, extracted: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Page texts from the cache where it has any, else as extracted."""
    kept = cache.filter(F.length(F.trim(text)) > 0).select(*keys, F.col(text).alias("_cached"))
    return extracted.join(kept, list(keys), "left").withColumn(text, F.coalesce("_cached", text)).drop("_cached")


def checkpoint(*logs: DataFrame) -> DataFrame:
    """``(term_index, next_skip)``: the most advanced row of several batch logs."""
    out = logs[0].select("term_index", "next_skip")
    for log in logs[1:]:
        out = out.unionByName(log.select("term_index", "next_skip"))
    return out.agg(F.max(F.struct("term_index", "next_skip")).alias("m")).select("m.*")


def isolated(sources: Mapping[str, object], spark: SparkSession) -> tuple[dict[str, DataFrame], DataFrame]:
    """Open each source; a failure becomes a ``failed`` row of the status table and stops no other. Sources are functions of no argument."""
    opened, status = {}, []
    for name, open_source in sources.items():
        try:
            opened[name] = open_source()
            status.append((name, "ok", ""))
        except Exception as error:  # noqa: BLE001
            status.append((name, "failed", str(error)[:500]))
    return opened, spark.createDataFrame(status, strings(["source", "status", "note"]))


