"""Sources: CSV drops, catalog tables, guards, and the derived deposit view."""

from stratum.sources.derived import deposits_from_orders, deposits_iso, qa_structure_from_parts
from stratum.sources.files import (
    CORRUPT_COL,
    DEPOSIT_COLUMNS,
    QA_STRUCTURE_COLUMNS,
    drop_files,
    only_files,
    period_path,
    qa_structure_schema,
    read_csv_declared,
    read_csv_strings,
    string_schema,
)
from stratum.sources.guards import (
    EmptyBatchError,
    EmptySourceError,
    MissingSourceError,
    open_source,
    require_batch,
    require_rows,
)
from stratum.sources.tables import read_table

__all__ = [
    "CORRUPT_COL", "DEPOSIT_COLUMNS", "EmptyBatchError", "EmptySourceError", "MissingSourceError",
    "QA_STRUCTURE_COLUMNS", "deposits_from_orders", "deposits_iso", "qa_structure_from_parts", "drop_files", "only_files", "open_source", "period_path",
    "qa_structure_schema", "read_csv_declared", "read_csv_strings", "read_table", "require_batch",
    "require_rows", "string_schema",
]
