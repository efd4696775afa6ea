"""Batch selection (BAT-1) and the global maximum it rests on (AGG-1)."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from stratum.operators.stamps import INGESTION_COL


def batch_max(df: DataFrame, ts_col: str = INGESTION_COL, alias: str = "latest_ts") -> DataFrame:
    """AGG-1: one-row frame with the largest stamp (NULL on empty input)."""
    return df.select(F.max(ts_col).alias(alias))


def latest_batch(df: DataFrame, ts_col: str = INGESTION_COL) -> DataFrame:
    """BAT-1: rows whose stamp equals the table-wide maximum.

    The maximum stays inside the plan as a scalar subquery: it is never turned
    into a Python value (a ``datetime`` round trip can name the wrong batch in
    a repeated clock hour), and Spark pushes ``ts = (subquery)`` into a Parquet
    scan as a runtime filter, so row groups of older batches are skipped by
    their min/max statistics. Ties are all kept, NULL stamps never match, an
    empty input gives an empty output.
    """
    return df.where(F.col(ts_col) == batch_max(df, ts_col).scalar())


def pin_latest_stamp(df: DataFrame, ts_col: str = INGESTION_COL) -> Column | None:
    """The latest stamp as an exact literal, or ``None`` when there is no batch.

    One small job (a one-column max). The value travels as epoch microseconds
    (TIMESTAMP) or as the value's own text (TIMESTAMP_NTZ and other types; the
    cast keeps every microsecond and knows no zone), never as a Python
    ``datetime``, so no session or OS time zone can shift it.
    A flow that reads the batch several times pins it once: every read sees
    the same batch even if another load lands meanwhile, the maximum is not
    recomputed over the whole history per read, and the literal filter is
    pushed into the scan at planning time.
    """
    text = latest_key(df, ts_col)
    return None if text is None else stamp_at(df, text, ts_col)


def latest_key(df: DataFrame, ts_col: str = INGESTION_COL) -> str | None:
    """The latest stamp as text that names it exactly: epoch microseconds (TIMESTAMP) or
    the value's own text (other types)."""
    return df.select(_key_of(df, F.max(ts_col), ts_col)).first()[0]


def _key_of(df: DataFrame, value: Column, ts_col: str) -> Column:
    zoned = isinstance(df.schema[ts_col].dataType, TimestampType)
    return (F.unix_micros(value) if zoned else value).cast("string")


def stamp_at(df: DataFrame, key: str, ts_col: str = INGESTION_COL) -> Column:
    """The stamp that ``key`` names, as a literal of the column's type."""
    dtype = df.schema[ts_col].dataType
    if isinstance(dtype, TimestampType):
        return F.timestamp_micros(F.lit(int(key)))
    return F.lit(key).cast(dtype)


def partition_keys(spark: SparkSession, table: str, ts_col: str = INGESTION_COL) -> list[str] | None:
    """AGG-1 from the catalog alone: the stamps of a table laid out by ``ts_col``, latest
    first, as ``latest_key`` writes them; ``None`` where the table is not partitioned by
    ``ts_col`` in the catalog.

    Partition names are read, no file is listed or opened. One stamp a batch comes to the
    driver. A TIMESTAMP column is left to ``latest_key``: its partition names are local
    times, which a repeated clock hour makes ambiguous.
    """
    columns = {c.name.lower(): c for c in spark.catalog.listColumns(table)}
    column = columns.get(ts_col.lower())
    if column is None or not column.isPartition or column.dataType == "timestamp":
        return None
    known = ".".join(f"`{part}`" for part in table.replace("`", "").split("."))
    try:
        names = spark.sql(f"SHOW PARTITIONS {known}")
    except AnalysisException:  # partitions that the catalog does not track
        return None
    text = F.regexp_extract("partition", f"(?:^|/){re.escape(column.name)}=([^/]*)", 1)
    value = F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))).cast(column.dataType)
    stamps = names.select(value.alias("v")).where(F.col("v").isNotNull()).distinct()
    return [r[0] for r in stamps.orderBy(F.desc("v")).select(F.col("v").cast("string")).collect()]


def batch_at(df: DataFrame, stamp: Column, ts_col: str = INGESTION_COL) -> DataFrame:
    """Rows of the batch stamped ``stamp`` (a pinned literal)."""
    return df.where(F.col(ts_col) == stamp)
