"""Ledger of what has landed where (SNK-1, SNK-5 made safe to run again).

A small table of (target, item, state, run, rows, at). An item is what must land once: a
batch's stamp, or a drop file with its modification time and size. A run writes
``started`` for its items before it appends and ``done`` after, so

* an item with ``done`` has landed: a second run leaves it out;
* an item with ``started`` and nothing after it was cut off between the two: the append
  may or may not have happened, which only its caller can find out. ``open`` raises
  ``InterruptedRunError``; ``settle`` then records which of the two it was.

Only appends are made to the ledger; the items of a run are one DataFrame, and what has
landed is left out by an anti join, so a ledger of many files stays distributed. Runs of
one target have to follow one another: the ledger is no lock.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STARTED, DONE, ABANDONED = "started", "done", "abandoned"
SCHEMA = "target string, item string, state string, run string, rows long, at timestamp"


class InterruptedRunError(RuntimeError):
    """An earlier run of the same items began its append and never reported its end."""

    def __init__(self, table: str, target: str, runs: list[str]):
        super().__init__(f"{table}: run(s) {', '.join(runs)} into {target} did not end; see what landed, then settle them")
        self.runs = runs


@dataclass
class Ledger:
    spark: SparkSession
    table: str
    path: str | None = None
    fmt: str | None = None

    def entries(self, target: str) -> DataFrame:
        if not self.spark.catalog.tableExists(self.table):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.table(self.table).where(F.col("target") == target)

    def landed(self, target: str) -> DataFrame:
        """item and rows (of its run) of everything that has landed."""
        return self.entries(target).where(F.col("state") == DONE).select("item", "rows").dropDuplicates(["item"])

    def open(self, target: str, items: DataFrame) -> DataFrame:
        """The rows of ``items`` (a column ``item``) that have not landed."""
        known = self.entries(target)
        ended = known.where(F.col("state") != STARTED).select("run").distinct()
        cut = known.where(F.col("state") == STARTED).join(ended, "run", "left_anti")
        cut = cut.join(items.select("item").distinct(), "item", "left_semi").select("run").distinct()
        if runs := sorted(r.run for r in cut.limit(10).collect()):
            raise InterruptedRunError(self.table, target, runs)
        return items.join(self.landed(target).select("item"), "item", "left_anti")

    def start(self, target: str, items: DataFrame) -> str:
        run = uuid.uuid4().hex
        self._append(items.select("item"), target, STARTED, run, None)
        return run

    def finish(self, target: str, run: str, rows: int) -> None:
        self._append(self._of(target, run), target, DONE, run, rows)

    def settle(self, target: str, run: str, landed: bool, rows: int | None = None) -> None:
        """Ends an interrupted run: its append has ``landed`` whole, or not at all."""
        self._append(self._of(target, run), target, DONE if landed else ABANDONED, run, rows)

    def _of(self, target: str, run: str) -> DataFrame:
        return self.entries(target).where((F.col("run") == run) & (F.col("state") == STARTED)).select("item")

    def _append(self, items: DataFrame, target: str, state: str, run: str, rows: int | None) -> None:
        frame = items.select(
            F.lit(target).alias("target"), "item", F.lit(state).alias("state"), F.lit(run).alias("run"),
            F.lit(rows).cast("long").alias("rows"), F.current_timestamp().alias("at"),
        )
        writer = frame.write.mode("append")
        if self.fmt:
            writer = writer.format(self.fmt)
        if self.path and not self.spark.catalog.tableExists(self.table):
            writer = writer.option("path", self.path)
        writer.saveAsTable(self.table)
