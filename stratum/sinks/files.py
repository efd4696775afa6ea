"""CSV file sink, used to stage monthly drops.

Spark's CSV writer trims leading and trailing spaces by default; drops are
written with both options off so a value such as two spaces survives the
round trip. An empty string is written as ``""`` and read back as NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(
    df: DataFrame,
    path: str,
    header: bool = True,
    mode: str = "errorifexists",
    partition_by: str | list[str] | None = None,
    compression: str = "none",
) -> None:
    writer = (
        df.write.mode(mode)
        .option("header", header)
        .option("compression", compression)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.csv(path)


def write_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a single string column as text lines (raw drops with any layout)."""
    df.write.mode(mode).text(path)
