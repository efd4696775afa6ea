"""Catalog table source (SRC-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC-5: the whole table by name; filters and column pruning reach its scan."""
    return spark.table(name)
