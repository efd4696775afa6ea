"""Counts (AGG-2) and the batch audit (AUD-1).

``audit_counts`` gives the batch audit as one aggregate in one job. In the
flows the same numbers come from ``Observation`` metrics attached to the
writes themselves (see ``stratum.sinks``), so counting never rescans a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.rules import Rule, passes


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """AGG-2 as a one-row frame (partial counts per task, one tiny exchange)."""
    return df.select(F.count(F.lit(1)).alias(alias))


def audit_counts(batch: DataFrame, rules: list[Rule], key: str = "account_id") -> DataFrame:
    """AUD-1: processed / valid / rejected / written for one batch.

    ``written`` is the number of rows a key-dedupe of the valid rows keeps:
    the distinct non-NULL keys among valid rows (valid rows always carry the
    key when it is one of the present-rules).
    """
    ok = passes(rules)
    return batch.select(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(ok).alias("valid"),
        F.count_if(~ok).alias("rejected"),
        F.count_distinct(F.when(ok, F.col(key))).alias("written"),
    )
