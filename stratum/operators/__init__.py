"""``DataFrame -> DataFrame`` operators of the medallion steps."""

from stratum.operators.audit import audit_counts, row_count
from stratum.operators.batches import batch_at, batch_max, latest_batch, latest_key, partition_keys, pin_latest_stamp, stamp_at
from stratum.operators.contract import (
    SILVER_8,
    SILVER_8_CAPS,
    SILVER_9,
    EmptyContractError,
    clean_deposits,
    project_to,
)
from stratum.operators.dedupe import dedupe_any, dedupe_first, dedupe_latest
from stratum.operators.rules import (
    deposit_rules,
    passes,
    reject_all,
    reject_distinct,
    rule_check,
    split,
    validate,
)
from stratum.operators.sets import except_rows
from stratum.operators.stamps import stamp_ingestion, stamp_source_file

__all__ = [
    "SILVER_8", "SILVER_8_CAPS", "SILVER_9", "EmptyContractError", "audit_counts", "batch_at", "batch_max", "pin_latest_stamp",
    "clean_deposits", "dedupe_any", "dedupe_first", "dedupe_latest", "deposit_rules", "except_rows",
    "latest_batch", "latest_key", "partition_keys", "passes", "project_to", "reject_all", "reject_distinct", "row_count",
    "rule_check", "split", "stamp_at", "stamp_ingestion", "stamp_source_file", "validate",
]
