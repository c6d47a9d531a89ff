"""Readers for the driver-provided Parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet``; callers select columns so the scan prunes."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
