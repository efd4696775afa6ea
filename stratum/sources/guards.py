"""Guards that stop a load early (SRC-6..SRC-8).

Each returns its input unchanged when the check passes, so guards compose
inside a flow. The emptiness checks use ``isEmpty`` (a one-row limit that
stops at the first non-empty partition), never a full count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame


class MissingSourceError(FileNotFoundError):
    """SRC-6: the source path does not exist."""


class EmptySourceError(RuntimeError):
    """SRC-7: the source holds no row."""


class EmptyBatchError(RuntimeError):
    """SRC-8: the table holds no batch to process."""


def _condition(e: AnalysisException) -> str:
    get = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    return (get() if get else None) or ""


def open_source(read: Callable[[], DataFrame], path: str) -> DataFrame:
    """SRC-6: run a (lazy) reader; a missing path raises ``MissingSourceError``.

    Spark checks the path when the reader is defined, before any job runs.
    """
    try:
        return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in _condition(e) or "Path does not exist" in str(e):
            raise MissingSourceError(f"source not found at path: {path}") from e
        raise


def require_rows(df: DataFrame, what: str = "source") -> DataFrame:
    """SRC-7: stop when ``df`` has no row."""
    if df.isEmpty():
        raise EmptySourceError(f"{what} is empty: no records to ingest")
    return df


def require_batch(batch: DataFrame, policy: str = "stop") -> DataFrame:
    """SRC-8: guard for an empty latest batch.

    ``policy="stop"`` raises ``EmptyBatchError``; ``"pass"`` lets the empty
    batch through (an overwrite sink would then erase its target).
    """
    if policy not in ("stop", "pass"):
        raise ValueError(f"policy must be 'stop' or 'pass', not {policy!r}")
    if policy == "stop" and batch.isEmpty():
        raise EmptyBatchError("no records found in the latest batch")
    return batch
