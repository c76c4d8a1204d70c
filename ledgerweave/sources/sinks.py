"""Sinks: CSV, JSON, GeoJSON, page sidecars and run logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, columns: Sequence[str], append: bool = False) -> None:
    """The given columns in their order, with a header; nulls as empty fields."""
    df.select(*columns).write.mode("append" if append else "overwrite").options(header=True, escape='"', emptyValue="", nullValue="").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def feature(geometry_type: Column, coordinates: Column, properties: Sequence[str]) -> Column:
    """One GeoJSON feature as text."""
    geometry = F.struct(geometry_type.alias("type"), coordinates.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry")))


def write_features(df: DataFrame, path: str, feature_column: str = "feature") -> None:
    """Features one per line (newline-delimited GeoJSON), so that no task holds the whole collection."""
    df.select(F.col(feature_column).alias("value")).write.mode("overwrite").text(path)


def feature_collection(df: DataFrame, feature_column: str = "feature") -> DataFrame:
    """One row with the whole collection, for tables known to be small."""
    return df.agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.sort_array(F.collect_list(feature_column)), ","), F.lit("]}")).alias("value"))


def write_pages(df: DataFrame, path: str, year: str = "year") -> None:
    """Page texts, one folder per year."""
    df.write.mode("overwrite").partitionBy(year).parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
