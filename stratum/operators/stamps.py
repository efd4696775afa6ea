"""Lineage stamps (PRJ-1, PRJ-2)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame

from stratum.functions.lineage import ingestion_time, source_file

INGESTION_COL = "ingestion_timestamp"
SOURCE_FILE_COL = "source_file_name"


def stamp_ingestion(
    df: DataFrame, ts: _dt.datetime | Column | None = None, name: str = INGESTION_COL
) -> DataFrame:
    """PRJ-1: one batch stamp on every row (``current_timestamp()`` unless given)."""
    return df.withColumn(name, ingestion_time(ts))


def stamp_source_file(df: DataFrame, name: str = SOURCE_FILE_COL) -> DataFrame:
    """PRJ-2: the file each row came from. Apply directly on a file scan."""
    return df.withColumn(name, source_file())
