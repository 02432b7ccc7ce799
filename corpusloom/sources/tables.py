"""Scans of the project's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder; columns are pruned and filters pushed by the reader."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
