"""Overwrites that are one catalog step (SNK-3, SNK-4 on file-source tables).

The new rows are written as a version of their own beside the old ones,
``<root>/v-<time>-<id>``, and only then does the table's location move there (one
``ALTER TABLE ... SET LOCATION``). A write that fails midway leaves the table as it
was; a reader meets either all old or all new rows, and one that has begun keeps the
files it was planned on: the version before the current one stays until the next
overwrite, older ones are deleted.

Such a table lists its partitions from its folder, not from the catalog: partitions
registered one by one could not be exchanged in one step. Appends, partition pruning
and reads by name work as for any other table; readers by path have to ask for the
table's location.

Two cases take two steps (drop, create) after the new rows are written: a table whose
schema, format or partitioning changes, and one made elsewhere with partitions in the
catalog, at its first overwrite. Its old files stay if the table is external.
"""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_TRACKED = "spark.sql.hive.manageFilesourcePartitions"
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.replace("`", "").split("."))


def described(spark: SparkSession, name: str) -> dict[str, str]:
    """The table's detail rows: Location, Type, Provider, Partition Provider."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").collect()
    start = next((i for i, r in enumerate(rows) if r.col_name == "# Detailed Table Information"), len(rows))
    return {r.col_name: r.data_type for r in rows[start:]}


def table_layout(spark: SparkSession, name: str) -> tuple[list[tuple[str, str]], list[str]]:
    """(name, type) of a table's columns, and its partition columns; from the catalog
    alone: resolving the table would list its files."""
    columns = spark.catalog.listColumns(name)
    return [(c.name, c.dataType) for c in columns], [c.name for c in columns if c.isPartition]


def layout(schema: StructType, parts: list[str]) -> list[tuple[str, str]]:
    """Column names and types as a table holds them: partition columns last."""
    fields = {f.name.lower(): (f.name, f.dataType.simpleString()) for f in schema.fields}
    last = [p.lower() for p in parts]
    return [v for k, v in fields.items() if k not in last] + [fields[p] for p in last]


@dataclass
class Staged:
    """A written version that no reader sees yet."""

    spark: SparkSession
    name: str
    location: str
    fmt: str
    columns: list[tuple[str, str]]
    parts: list[str]
    root: str
    external: bool

    def commit(self) -> None:
        """Makes the version the table's content."""
        spark, known = self.spark, quoted(self.name)
        exists = spark.catalog.tableExists(self.name)
        if exists and not self._same_layout():
            spark.sql(f"DROP TABLE {known}")
            exists = False
        if not exists:
            self._create()
        with _listing_tasks(spark):
            spark.sql(f"ALTER TABLE {known} SET LOCATION '{self.location}'")
        _delete_older(spark, self.root, self.location)

    def abort(self) -> None:
        path, fs = hadoop_path(self.spark, self.location)
        fs.delete(path, True)

    def _same_layout(self) -> bool:
        now = described(self.spark, self.name)
        columns, parts = table_layout(self.spark, self.name)
        return (
            now.get("Provider", "").lower() == self.fmt
            and "Partition Provider" not in now
            and columns == self.columns
            and [p.lower() for p in parts] == [p.lower() for p in self.parts]
        )

    def _create(self) -> None:
        """The table without rows, in a session of its own: the caller's settings stay."""
        side = self.spark.newSession()
        side.conf.set(_TRACKED, "false")
        known = quoted(self.name if "." in self.name else f"{self.spark.catalog.currentDatabase()}.{self.name}")
        columns = ", ".join(f"`{c}` {kind}" for c, kind in self.columns)
        by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in self.parts)})" if self.parts else ""
        at = f" LOCATION '{self.root}/v-0'" if self.external else ""
        side.sql(f"CREATE TABLE {known} ({columns}) USING {self.fmt}{by}{at}")


def stage(df: DataFrame, name: str, fmt: str, parts: list[str], path: str | None) -> Staged:
    """Writes ``df`` as a new version of ``name``; ``commit`` shows it."""
    spark = df.sparkSession
    root, external = _root(spark, name, path)
    staged = Staged(
        spark, name, f"{root}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}", fmt.lower(),
        layout(df.schema, parts), parts, root, external,
    )
    writer = df.write.format(staged.fmt)
    if parts:
        writer = writer.partitionBy(*parts)
    try:
        writer.save(staged.location)
    except BaseException:
        staged.abort()
        raise
    return staged


def _root(spark: SparkSession, name: str, path: str | None) -> tuple[str, bool]:
    """The folder of the table's versions, and whether the table is external. A managed
    table's versions lie beside its own folder, which a drop deletes."""
    if path:
        return path.rstrip("/"), True
    if spark.catalog.tableExists(name):
        now = described(spark, name)
        if now["Type"] == "EXTERNAL":
            at = now["Location"].rstrip("/")
            return (at.rsplit("/", 1)[0] if at.rsplit("/", 1)[-1].startswith("v-") else at), True
    parts = name.replace("`", "").split(".")
    database = parts[-2] if len(parts) > 1 else spark.catalog.currentDatabase()
    home = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    return f"{home}/{parts[-1]}__versions", False


@contextmanager
def _listing_tasks(spark: SparkSession):
    """The step refreshes the table, which lists its new folders: a task a core, not one a
    folder. The caller's setting comes back."""
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


def hadoop_path(spark: SparkSession, location: str):
    """A folder and the file system it is on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete_older(spark: SparkSession, root: str, current: str) -> None:
    """Deletes the versions before the one that ``current`` replaced; versions newer than
    ``current`` belong to writers that have not committed."""
    path, fs = hadoop_path(spark, root)
    names = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith("v-"))
    older = [n for n in names if n < current.rsplit("/", 1)[-1]]
    for n in older[:-1]:
        fs.delete(hadoop_path(spark, f"{root}/{n}")[0], True)
