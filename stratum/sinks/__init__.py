"""Sinks: catalog tables (append / overwrite, partitioned, staged, by batch, fan-out), run
ledgers and CSV drops."""

from stratum.sinks.files import write_csv, write_text
from stratum.sinks.ledger import InterruptedRunError, Ledger
from stratum.sinks.staged import Staged, stage
from stratum.sinks.tables import (
    TargetMismatchError,
    append_table,
    check_target,
    overwrite_table,
    replace_batch,
    write_split,
    write_table,
)

__all__ = [
    "InterruptedRunError", "Ledger", "Staged", "TargetMismatchError", "append_table", "check_target", "overwrite_table",
    "replace_batch", "stage", "write_csv", "write_split", "write_table", "write_text",
]
