"""User-level flows (FLOW-1..FLOW-5): landing and refining a monthly batch.

Each flow is a handful of lazy DataFrame steps ending in one to three
writes; the counts it reports come from ``Observation`` metrics on those
writes, never from a rescan:

* ``ingest_declared``: emptiness check (one-row limit) + one append job;
  ``ingest_strings``: one append job (its landing step has no guard).
* ``refine_replace`` / ``refine_append``: one tiny job pinning the latest
  stamp (a one-column max; NULL means no batch), a one-row check that the
  stamp selects something + one write job.
* ``refine_validated``: the pinning job + three write jobs (rejects, valid,
  silver). Both
  batch reads use the pinned literal, so they see the same batch even if
  another load lands meanwhile, and the filter prunes row groups at planning
  time. Silver is built from the validated table just written, so the raw
  history is not read a third time and lineage is cut at a table.

The ``*_plan`` functions are the same steps as lazy DataFrames (latest batch
as a scalar subquery) with no sink, for composition and inspection.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.functions.values import DATE_DAY_FIRST, DATE_ISO
from stratum.operators.batches import batch_at, latest_batch, latest_key, partition_keys, stamp_at
from stratum.operators.contract import (
    SILVER_8,
    SILVER_8_CAPS,
    SILVER_9,
    Contract,
    clean_deposits,
    project_to,
)
from stratum.operators.dedupe import dedupe_any, dedupe_first
from stratum.operators.rules import Rule, deposit_rules, passes, reject_all, reject_distinct, validate
from stratum.operators.stamps import stamp_ingestion, stamp_source_file
from stratum.sinks.ledger import Ledger
from stratum.sinks.tables import append_table, check_target, overwrite_table, replace_batch
from stratum.sources.files import drop_files, only_files, read_csv_declared, read_csv_strings
from stratum.sources.guards import EmptyBatchError, open_source, require_rows
from stratum.sources.tables import read_table

DEDUPE_KEY = "account_id"


# --------------------------------------------------------------------------
# dedupe orders (DED-1, DED-2) over whatever letter case the columns carry
# --------------------------------------------------------------------------
def _name(df: DataFrame, logical: str) -> str | None:
    for c in df.columns:
        if c.lower() == logical.lower():
            return c
    return None


def first_order(df: DataFrame) -> list[Column]:
    """DED-1: deposit_id ascending (NULLs last), then timestamp text, amount, phone."""
    names = [_name(df, n) for n in ("deposit_id", "deposit_timestamp", "amount", "phone_number")]
    return [F.col(n).asc_nulls_last() for n in names if n]


def latest_order(df: DataFrame) -> list[Column]:
    """DED-2: deposit_date descending (NULLs last), then as ``first_order``."""
    date = _name(df, "deposit_date")
    head = [F.col(date).desc_nulls_last()] if date else []
    return head + first_order(df)


def dedupe_by_account(df: DataFrame, how: str) -> DataFrame:
    """AGG-3 (``any``), DED-1 (``first``) or DED-2 (``latest``) on the account key."""
    key = _name(df, DEDUPE_KEY)
    if key is None:
        raise ValueError(f"no {DEDUPE_KEY} column to dedupe on")
    if how == "any":
        return dedupe_any(df, [key])
    if how == "first":
        return dedupe_first(df, [key], first_order(df))
    if how == "latest":
        return dedupe_first(df, [key], latest_order(df))
    raise ValueError(f"dedupe must be 'any', 'first' or 'latest', not {how!r}")


def _date_target(contract: Contract) -> str:
    return next(t for s, _, t in contract if s == "deposit_date")


def pinned_batch(raw: DataFrame, empty_batch: str = "stop", table: str | None = None) -> DataFrame:
    """BAT-1 + SRC-8 for one flow run: the latest batch under a pinned stamp.

    ``empty_batch="stop"`` raises ``EmptyBatchError`` when the table holds no
    stamped row; ``"pass"`` hands on an empty batch (an overwrite would then
    erase its target).
    """
    return pinned(raw, empty_batch, table)[0]


def pinned(raw: DataFrame, empty_batch: str = "stop", table: str | None = None) -> tuple[DataFrame, str | None]:
    """The latest batch of ``raw`` and the text that names its stamp.

    Where ``table`` (the name of ``raw``) is laid out by the stamp, the stamps are its
    partition names in the catalog: no row is read to find the latest one. Partitions
    left without rows are passed over.
    """
    if empty_batch not in ("stop", "pass"):
        raise ValueError(f"empty_batch must be 'stop' or 'pass', not {empty_batch!r}")
    keys = partition_keys(raw.sparkSession, table) if table else None
    if keys is None:
        keys = [k] if (k := latest_key(raw)) is not None else []
    for key in keys:
        batch = batch_at(raw, stamp_at(raw, key))
        if not batch.isEmpty():
            return batch, key
    if empty_batch == "stop":
        what = "the pinned stamp selects no row" if keys else "the table holds no stamped row, so there is no batch to refine"
        raise EmptyBatchError(f"{what}; the target is left as it is")
    return raw.where(F.lit(False)), None


# --------------------------------------------------------------------------
# FLOW-1, FLOW-2: landing
# --------------------------------------------------------------------------
def ingest_declared(
    spark: SparkSession,
    source_path: str,
    table: str,
    schema: StructType,
    fmt: str | None = None,
    ingestion_ts: _dt.datetime | Column | None = None,
    path: str | None = None,
    partition_by: str | list[str] | None = None,
    ledger: Ledger | None = None,
    spread: int | None = None,
) -> dict[str, int]:
    """FLOW-1: declared-schema CSV drop -> stamps -> append to the raw table.

    Malformed rows are kept with their text in ``_corrupt_record``; every row
    gets the batch stamp and its source file. ``partition_by="ingestion_timestamp"``
    lays the raw table out by batch, so that reading the latest one skips the
    folders of all earlier ones (give the stamp as TIMESTAMP_NTZ where the session
    zone repeats an hour: folder names hold local time).

    ``ledger`` lands each file of the drop once, however often the flow runs.
    ``spread`` deals the rows of files that cannot be split (gzip) over so many tasks
    before they are stamped and written; each keeps the file it came from.
    """
    raw = open_source(lambda: read_csv_declared(spark, source_path, schema), source_path)
    require_rows(raw)
    return _land(spark, raw, source_path, table, fmt, ingestion_ts, path, partition_by, ledger, spread, stamp_source_file)


def ingest_strings(
    spark: SparkSession,
    source_path: str,
    table: str,
    fmt: str | None = None,
    ingestion_ts: _dt.datetime | Column | None = None,
    path: str | None = None,
    partition_by: str | list[str] | None = None,
    ledger: Ledger | None = None,
    spread: int | None = None,
) -> dict[str, int]:
    """FLOW-2: header-named all-string CSV drop -> stamp -> append (``partition_by``,
    ``ledger`` and ``spread`` as in ``ingest_declared``)."""
    raw = open_source(lambda: read_csv_strings(spark, source_path), source_path)
    return _land(spark, raw, source_path, table, fmt, ingestion_ts, path, partition_by, ledger, spread, lambda df: df)


def _land(spark, raw, source_path, table, fmt, ingestion_ts, path, partition_by, ledger, spread, with_file) -> dict[str, int]:
    """Appends the rows of a drop; under a ledger those of its files that have not
    landed. Counts come from the write."""
    new = run = None
    if ledger is not None:
        new = ledger.open(table, drop_files(spark, source_path)).collect()  # the files of one drop
        if not new:
            return {"rows": 0, "files": 0}
        raw = only_files(raw, [f.file_path for f in new])
    rows = with_file(raw)  # the file is known at the scan, not after a shuffle
    if spread:
        rows = rows.repartition(spread)
    if new is not None:
        run = ledger.start(table, spark.createDataFrame([(f.item,) for f in new], "item string"))
    n = append_table(stamp_ingestion(rows, ingestion_ts), table, fmt=fmt, path=path, partition_by=partition_by, count=True)
    if new is None:
        return {"rows": n or 0}
    ledger.finish(table, run, n or 0)
    return {"rows": n or 0, "files": len(new)}


# --------------------------------------------------------------------------
# FLOW-3, FLOW-4, FLOW-5: refining the latest batch
# --------------------------------------------------------------------------
def refine_batch(
    batch: DataFrame,
    dedupe: str = "any",
    contract: Contract = SILVER_8,
    date_format: str = DATE_DAY_FIRST,
    precision: int = 15,
    strict: bool = False,
) -> DataFrame:
    """FLOW-3's steps on one batch: dedupe (before cleaning, on the raw
    account key) -> clean -> contract."""
    deduped = dedupe_by_account(batch, dedupe)
    return project_to(clean_deposits(deduped, date_format, precision, strict), contract)


def refine_replace_plan(
    raw: DataFrame,
    dedupe: str = "any",
    contract: Contract = SILVER_8,
    date_format: str = DATE_DAY_FIRST,
    precision: int = 15,
    strict: bool = False,
) -> DataFrame:
    """FLOW-3 without its sink: latest batch -> dedupe -> clean -> contract."""
    return refine_batch(latest_batch(raw), dedupe, contract, date_format, precision, strict)


def refine_replace(
    spark: SparkSession,
    source_table: str,
    target_table: str,
    dedupe: str = "any",
    contract: Contract = SILVER_8,
    date_format: str = DATE_DAY_FIRST,
    precision: int = 15,
    strict: bool = False,
    empty_batch: str = "stop",
    fmt: str | None = None,
    path: str | None = None,
    writers: int | None = None,
) -> dict[str, int]:
    """FLOW-3: overwrite the silver table, partitioned by date, with the latest batch
    (``writers`` as in ``write_table``)."""
    batch = pinned_batch(read_table(spark, source_table), empty_batch, source_table)
    silver = refine_batch(batch, dedupe, contract, date_format, precision, strict)
    n = overwrite_table(
        silver, target_table, fmt=fmt, partition_by=_date_target(contract), path=path, count=True, writers=writers,
    )
    return {"written": n or 0}


def silver_from_valid(
    valid: DataFrame,
    dedupe: str = "any",
    contract: Contract = SILVER_8_CAPS,
    date_format: str = DATE_DAY_FIRST,
    precision: int = 18,
    strict: bool = False,
) -> DataFrame:
    """FLOW-4's refining half: clean -> contract -> dedupe (after projection)."""
    return dedupe_by_account(project_to(clean_deposits(valid, date_format, precision, strict), contract), dedupe)


def refine_validated(
    spark: SparkSession,
    source_table: str,
    valid_table: str,
    rejected_table: str,
    silver_table: str,
    rules: list[Rule] | None = None,
    rejects: str = "distinct",
    dedupe: str = "any",
    contract: Contract = SILVER_8_CAPS,
    date_format: str = DATE_DAY_FIRST,
    precision: int = 18,
    strict: bool = False,
    empty_batch: str = "stop",
    fmt: str | None = None,
    paths: dict[str, str] | None = None,
    formats: dict[str, str] | None = None,
    quarantine: str = "append",
    writers: int | None = None,
) -> dict[str, int]:
    """FLOW-4: validate the latest batch, quarantine rejects, refine the rest.

    ``paths`` / ``formats`` are keyed ``"valid"``, ``"rejected"``, ``"silver"``
    (a format given per table wins over ``fmt``; e.g. Delta for silver only).

    ``quarantine="append"`` adds the rejects to the quarantine table, as coded: a second
    run of the same batch adds them again. ``"batch"`` keeps that table by batch (its
    column ``batch_key``), and a second run replaces what the first one left.

    Returns the audit (AUD-1): ``processed``, ``valid``, ``rejected`` (rows
    failing a rule), ``rejected_written`` (rows appended to the quarantine
    table: fewer than ``rejected`` under the EXCEPT-DISTINCT reading) and
    ``written`` (silver rows after dedupe).
    """
    if rejects not in ("distinct", "all"):
        raise ValueError(f"rejects must be 'distinct' or 'all', not {rejects!r}")
    if quarantine not in ("append", "batch"):
        raise ValueError(f"quarantine must be 'append' or 'batch', not {quarantine!r}")
    rules = rules if rules is not None else deposit_rules()
    paths = paths or {}
    fmts = {k: (formats or {}).get(k, fmt) for k in ("valid", "rejected", "silver")}
    batch, key = pinned(read_table(spark, source_table), empty_batch, source_table)

    rejected = reject_distinct(batch, rules) if rejects == "distinct" else reject_all(batch, rules)
    if quarantine == "append":
        n_rej = append_table(rejected, rejected_table, fmt=fmts["rejected"], path=paths.get("rejected"), count=True)
    else:
        n_rej = 0 if key is None else replace_batch(
            rejected, rejected_table, key, fmt=fmts["rejected"], path=paths.get("rejected"))

    # processed / valid / rejected are observed on the whole batch inside the
    # valid write: a shuffle-free job, so the metrics come from result tasks only
    obs = Observation(f"stratum_audit_{uuid.uuid4().hex[:8]}")
    ok = passes(rules)
    observed = batch.observe(
        obs,
        F.count(F.lit(1)).alias("processed"),
        F.count_if(ok).alias("valid"),
        F.count_if(~ok).alias("rejected"),
    )
    overwrite_table(validate(observed, rules), valid_table, fmt=fmts["valid"], path=paths.get("valid"))
    audit = {k: int(v) for k, v in obs.get.items()}

    silver = silver_from_valid(read_table(spark, valid_table), dedupe, contract, date_format, precision, strict)
    n_silver = overwrite_table(
        silver, silver_table, fmt=fmts["silver"], partition_by=_date_target(contract), path=paths.get("silver"),
        count=True, writers=writers,
    )
    audit.update(rejected_written=n_rej or 0, written=n_silver or 0)
    return audit


def append_batch(
    batch: DataFrame,
    contract: Contract = SILVER_9,
    date_format: str = DATE_ISO,
    precision: int = 18,
    strict: bool = False,
) -> DataFrame:
    """FLOW-5's steps on one batch: clean (+ integer CUSTOMER_ID) -> contract."""
    return project_to(clean_deposits(batch, date_format, precision, strict, customer_id=True), contract)


def refine_append_plan(
    validated: DataFrame,
    contract: Contract = SILVER_9,
    date_format: str = DATE_ISO,
    precision: int = 18,
    strict: bool = False,
) -> DataFrame:
    """FLOW-5 without its sink: latest batch -> clean -> contract."""
    return append_batch(latest_batch(validated), contract, date_format, precision, strict)


def refine_append(
    spark: SparkSession,
    source_table: str,
    target_table: str,
    contract: Contract = SILVER_9,
    date_format: str = DATE_ISO,
    precision: int = 18,
    strict: bool = False,
    empty_batch: str = "stop",
    fmt: str | None = None,
    path: str | None = None,
    ledger: Ledger | None = None,
    check: bool = False,
    writers: int | None = None,
) -> dict[str, int]:
    """FLOW-5: append the latest validated batch to the history-keeping silver table.

    Without a ``ledger`` a second run appends the batch again, as coded. With one, a
    batch that has landed is left out (``already_landed``: its rows then), and one whose
    append was cut off raises ``InterruptedRunError``. ``check`` compares the rows with
    the target's columns before anything is written.
    """
    batch, key = pinned(read_table(spark, source_table), empty_batch, source_table)
    silver = append_batch(batch, contract, date_format, precision, strict)
    if check:
        check_target(silver, target_table, _date_target(contract))
    run = None
    if ledger is not None and key is not None:
        item = spark.createDataFrame([(f"{source_table}|{key}",)], "item string")
        if ledger.open(target_table, item).isEmpty():
            landed = ledger.landed(target_table).join(item, "item", "left_semi").first()
            return {"written": 0, "already_landed": landed.rows or 0}
        run = ledger.start(target_table, item)
    n = append_table(
        silver, target_table, fmt=fmt, partition_by=_date_target(contract), path=path, count=True, writers=writers,
    )
    if run is not None:
        ledger.finish(target_table, run, n or 0)
    return {"written": n or 0}
