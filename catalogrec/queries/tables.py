"""Table access for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, key: str, *columns: str) -> DataFrame:
    """The text columns of a table, spread over the cores before row-wise work."""
    return spread(table(spark, sf_dir, name).select(key, *columns), key)
