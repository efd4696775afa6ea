"""Lineage values (FN-10, FN-11)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ingestion_time(ts: _dt.datetime | Column | None = None) -> Column:
    """FN-10: the batch stamp.

    ``None`` gives ``current_timestamp()``: one value for every row of a query,
    but a new value for every action on the same lazy DataFrame, so land once
    and read the table back rather than re-running a stamped plan.
    """
    if ts is None:
        return F.current_timestamp()
    return ts if isinstance(ts, Column) else F.lit(ts)


def source_file() -> Column:
    """FN-11: full URI of the file the row was read from."""
    return F.input_file_name()
