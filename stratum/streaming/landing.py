"""Incremental landing of monthly drops with Structured Streaming.

The batch landing flows (FLOW-1/FLOW-2) read the one drop they are pointed
at. When drops keep arriving under one folder, the same landing can run as a
file stream with ``trigger(availableNow=True)``: each run picks up only the
files not yet landed (the checkpoint records them), stamps them, appends them
and stops. The checkpoint makes a re-run after a failure land each file
exactly once.

``current_timestamp()`` in a stream is the micro-batch time, so every file
landed by one micro-batch shares one stamp -- the batch id that
``latest_batch`` selects later. With the default (unlimited) files per
trigger, one run lands everything new as one batch.

Land a table either with this stream or with the batch flows, not both: the
file sink keeps a ``_spark_metadata`` log in the table's folder, and readers
of that folder see only the files the log records.
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from stratum.operators.stamps import stamp_ingestion, stamp_source_file
from stratum.sources.files import CORRUPT_COL


METRICS = "stratum_landed"


class LandedRows(StreamingQueryListener):
    """Rows of each micro-batch of one query, as observed inside the batch (AUD-1 of a
    stream): every trigger reports its own, and what others write to the table does not
    count."""

    def __init__(self):
        self.batches: dict[tuple[str, int], int] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        metrics = event.progress.observedMetrics.get(METRICS)
        if metrics is not None:
            with self.changed:
                self.batches[str(event.progress.runId), event.progress.batchId] = int(metrics["rows"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def rows(self, run: str, timeout: float = 60) -> int:
        """All rows of a query that has ended; its last events may still be on their way."""
        with self.changed:
            if not self.changed.wait_for(lambda: run in self.ended, timeout):
                raise TimeoutError(f"the end of streaming query {run} was not reported")
            return sum(n for (of, _), n in self.batches.items() if of == run)


def land_new_drops(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    table: str,
    checkpoint: str,
    header: bool = True,
    fmt: str | None = None,
    path: str | None = None,
    with_source_file: bool = True,
    **options: str,
) -> dict[str, int]:
    """Land every not-yet-landed file under ``source_dir``, whatever its name, into
    ``table`` (compressed drops included, as in the batch reader).

    Returns ``{"rows": n}``: the rows this run landed, observed inside its micro-batches
    and summed over all of them; the table is not read. ``checkpoint`` is the table's own folder, the same in every run: it
    records what has landed. ``options`` go to the file source, e.g.
    ``cleanSource="archive", sourceArchiveDir=...`` to move landed drops out
    of the folder so that later runs do not list years of old files.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", True)
    )
    if CORRUPT_COL in schema.fieldNames():
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    for k, v in options.items():
        reader = reader.option(k, v)
    stream = stamp_ingestion(reader.csv(source_dir))
    if with_source_file:
        stream = stamp_source_file(stream)
    stream = stream.observe(METRICS, F.count(F.lit(1)).alias("rows"))
    writer = (
        stream.writeStream.outputMode("append")
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
    )
    if fmt:
        writer = writer.format(fmt)
    if path:
        writer = writer.option("path", path)
    landed = LandedRows()
    spark.streams.addListener(landed)
    try:
        query = writer.toTable(table)
        query.awaitTermination()
        return {"rows": landed.rows(str(query.runId))}
    finally:
        spark.streams.removeListener(landed)
