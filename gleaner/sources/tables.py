"""Named parquet tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; columns are pruned by the scan, so callers just select."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
