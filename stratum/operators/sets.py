"""Set difference of two independent tables (SET-1 without the one-scan shortcut)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left EXCEPT right``: the distinct rows of ``left`` that ``right`` does not hold.

    For a batch minus a table written elsewhere, where ``reject_distinct`` has no rule to
    negate. Columns pair by position and take their names from ``left``; NULLs are equal.

    One aggregate over both sides, not a join: rows are grouped by all columns, with how
    far they are in either side, so repeated rows collapse before the only shuffle
    (however often one row repeats, a task sends it once), both sides meet in the same
    partitioning, and NULLs need no null-safe keys.
    """
    if len(left.columns) != len(right.columns):
        raise ValueError(f"{len(left.columns)} columns against {len(right.columns)}")
    names = [f"c{i}" for i in range(len(left.columns))]
    sides = [d.toDF(*names).withColumn("other", F.lit(other)) for d, other in ((left, False), (right, True))]
    grouped = sides[0].union(sides[1]).groupBy(*names).agg(F.bool_or("other").alias("other"))
    return grouped.where(~F.col("other")).select(*names).toDF(*left.columns)
