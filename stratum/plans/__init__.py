"""Composite flows: the medallion steps wired end to end."""

from stratum.plans.flows import (
    append_batch,
    dedupe_by_account,
    first_order,
    ingest_declared,
    ingest_strings,
    latest_order,
    pinned_batch,
    refine_append,
    refine_append_plan,
    refine_batch,
    refine_replace,
    refine_replace_plan,
    refine_validated,
    silver_from_valid,
)

__all__ = [
    "append_batch", "pinned_batch", "refine_batch", "dedupe_by_account", "first_order", "ingest_declared", "ingest_strings", "latest_order",
    "refine_append", "refine_append_plan", "refine_replace", "refine_replace_plan",
    "refine_validated", "silver_from_valid",
]
