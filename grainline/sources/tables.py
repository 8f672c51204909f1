"""Scans of named tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str | None, name: str) -> DataFrame:
    """A table by name: from a folder of Parquet files, or from the catalog."""
    if folder is None:
        return spark.table(name)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
