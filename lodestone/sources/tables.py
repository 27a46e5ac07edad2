"""Readers for the Parquet tables of a dataset directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table ``name`` under ``root``; a single file or a folder of part files."""
    return spark.read.parquet(f"{root}/{name}.parquet")
