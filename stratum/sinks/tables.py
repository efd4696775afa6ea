"""Table sinks (SNK-1..SNK-6) with counts taken inside the write (AUD-1).

Partitioned writes: without a shuffle every task writes one file per date it
holds (tasks x dates small files). A ``REBALANCE`` on the partition columns
groups each date's rows, and adaptive execution splits a date that holds a
large share of the batch into several tasks and merges small ones -- unlike a
plain ``repartition(col)``, which would send a hot date to one task.

``writers`` (a number the caller fixes, whatever the data) replaces it by a hash
partitioning into so many tasks, for layouts where the number of files matters
more than their size.

Counting: ``count=True`` attaches an ``Observation`` at the top of the plan
being written, so the row count comes from the same job -- no second scan,
and no re-evaluation of ``current_timestamp()``. Sitting above every exchange,
it is collected in the result stage, whose metrics are taken once per
partition, so tasks re-run after an executor loss are not counted twice.

Overwrites of file-source tables are staged (``staged.py``): the old rows stay until the
new ones are complete, and the table changes in one catalog step. Transactional formats
keep their own atomic overwrite.
"""

from __future__ import annotations

import itertools
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stratum.sinks.staged import described, hadoop_path, layout, quoted, stage, table_layout

APPEND, OVERWRITE = "append", "overwrite"

# Hive-style file-source table formats (partitions tracked in the catalog).
FILE_FORMATS = {"parquet", "orc", "csv", "json", "avro", "text"}


def _as_list(cols: str | list[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def write_table(
    df: DataFrame,
    name: str,
    mode: str,
    fmt: str | None = None,
    partition_by: str | list[str] | None = None,
    path: str | None = None,
    rebalance: bool = True,
    count: bool = False,
    writers: int | None = None,
) -> int | None:
    """Write ``df`` to catalog table ``name``; returns the row count when asked.

    ``fmt`` defaults to the session's table format (``spark.sql.sources.default``);
    pass ``"delta"`` where that format's jars are on the classpath. ``path``
    makes it an external table at that location. ``writers`` fixes
    the number of tasks of a partitioned write.
    """
    if mode not in (APPEND, OVERWRITE):
        raise ValueError(f"mode must be append or overwrite, not {mode!r}")
    parts = _as_list(partition_by)
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if mode == APPEND and exists:
        path = None  # the table knows its location
    if parts and mode == APPEND and not exists and _file_format(spark, name, fmt, exists):
        # Create the table empty, then append: creating a partitioned
        # file-source table from data makes Spark list every new partition
        # folder in a second job to register it, while an append registers the
        # partitions its own write reports.
        _write(df.limit(0), name, mode, fmt, parts, path)
    if parts and rebalance:
        df = df.repartition(writers, *parts) if writers else df.hint("rebalance", *parts)
    obs = None
    if count:
        # above any exchange: counted in the result stage that writes the files
        obs = Observation(f"stratum_write_{uuid.uuid4().hex[:8]}")
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if mode == OVERWRITE and _file_format(spark, name, fmt, exists):
        stage(df, name, fmt or spark.conf.get("spark.sql.sources.default", "parquet"), parts, path).commit()
    else:
        _write(df, name, mode, fmt, parts, path)
    return int(obs.get["rows"]) if obs is not None else None


def _file_format(spark, name: str, fmt: str | None, exists: bool) -> bool:
    """Whether the target is (or will be) a Hive-style file-source table."""
    provider = fmt
    if provider is None and exists:
        provider = described(spark, name).get("Provider")
    if provider is None:
        provider = spark.conf.get("spark.sql.sources.default", "parquet")
    return str(provider).lower() in FILE_FORMATS


def _write(df: DataFrame, name: str, mode: str, fmt: str | None, parts: list[str], path: str | None) -> None:
    writer = df.write.mode(mode)
    if fmt:
        writer = writer.format(fmt)
    if parts:
        # an overwrite replaces every partition, whatever the session default
        writer = writer.partitionBy(*parts).option("partitionOverwriteMode", "static")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def append_table(df: DataFrame, name: str, **kw) -> int | None:
    """SNK-1 / SNK-2 / SNK-5: add rows; earlier rows (and partitions) are kept."""
    return write_table(df, name, APPEND, **kw)


def overwrite_table(df: DataFrame, name: str, **kw) -> int | None:
    """SNK-3 / SNK-4: replace the whole table; partitioned tables lose every
    old partition (static overwrite), not only the ones rewritten."""
    return write_table(df, name, OVERWRITE, **kw)


class TargetMismatchError(ValueError):
    """The rows do not fit the table they are meant for."""


def check_target(df: DataFrame, name: str, partition_by: str | list[str] | None = None) -> DataFrame:
    """PRJ-3 against the catalog: ``df`` unchanged if table ``name`` does not exist yet or
    has its columns, names, types and order alike (partition columns last, letter case
    aside), and is partitioned by ``partition_by``. Otherwise raises, before any file is
    written: an append matches columns by name and casts what differs.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        return df
    parts = _as_list(partition_by)
    columns, has = table_layout(spark, name)
    if [p.lower() for p in parts] != [p.lower() for p in has]:
        raise TargetMismatchError(f"{name} is partitioned by {has or 'nothing'}, the rows by {parts or 'nothing'}")
    given, wanted = ([(c.lower(), kind) for c, kind in side] for side in (layout(df.schema, parts), columns))
    if given != wanted:
        odd = [f"{g or 'nothing'} for {w or 'nothing'}" for g, w in itertools.zip_longest(given, wanted) if g != w]
        raise TargetMismatchError(f"{name} has other columns: {'; '.join(odd)}")
    return df


def replace_batch(
    df: DataFrame,
    name: str,
    batch: str,
    key: str = "batch_key",
    fmt: str | None = None,
    path: str | None = None,
) -> int:
    """SNK-6, re-runnable: the rows of one batch replace those the table holds of it.

    The table is partitioned by ``key``, which holds the batch's name on every row; a
    dynamic partition overwrite touches this partition alone, so refining a batch again
    leaves its rows once and those of all others as they are. Without rows the partition
    goes. Returns the rows written.
    """
    spark = df.sparkSession
    keyed = df.withColumn(key, F.lit(batch))
    if not spark.catalog.tableExists(name):
        _write(keyed.limit(0), name, APPEND, fmt, [key], path)
    check_target(keyed, name, key)
    table = described(spark, name)
    obs = Observation(f"stratum_batch_{uuid.uuid4().hex[:8]}")
    rows = keyed.select(*(c for c, _ in table_layout(spark, name)[0])).observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode(OVERWRITE).format(table["Provider"]).partitionBy(key)
    writer.option("partitionOverwriteMode", "dynamic").save(table["Location"])
    n = int(obs.get["rows"])
    if not n:
        _drop_folder(spark, table["Location"], key, batch)
    if "Partition Provider" in table:
        literal = batch.replace("\\", "\\\\").replace("'", "\\'")
        change = "ADD IF NOT EXISTS" if n else "DROP IF EXISTS"
        spark.sql(f"ALTER TABLE {quoted(name)} {change} PARTITION (`{key}` = '{literal}')")
    spark.catalog.refreshTable(name)
    return n


def _drop_folder(spark, location: str, key: str, batch: str) -> None:
    root, fs = hadoop_path(spark, location)
    for status in fs.listStatus(root):
        column, _, value = status.getPath().getName().partition("=")
        if column.lower() == key.lower() and unquote(value) == batch:
            fs.delete(status.getPath(), True)


def write_split(
    valid: DataFrame,
    rejected: DataFrame,
    valid_table: str,
    rejected_table: str,
    valid_path: str | None = None,
    rejected_path: str | None = None,
    fmt: str | None = None,
) -> dict[str, int]:
    """SNK-6: rejected rows are appended to the quarantine table, valid rows
    overwrite the validated table; both counts come from the writes."""
    n_rejected = append_table(rejected, rejected_table, fmt=fmt, path=rejected_path, count=True)
    n_valid = overwrite_table(valid, valid_table, fmt=fmt, path=valid_path, count=True)
    return {"valid": n_valid or 0, "rejected": n_rejected or 0}
