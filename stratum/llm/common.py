"""Shared helpers: table access, lineage cuts, shipping the package to workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from stratum.scratch import scratch_path

ARROW_ROWS = 1_000  # texts a Python worker is handed at once; the longest set its memory
RANGE_BYTES = 64 << 20  # of a range in a range sort, however large the input
_SHIPPED: set[str] = set()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    Workers do not see the driver's ``sys.path``; the package goes out as a zip
    through ``addPyFile``, as ``--py-files`` would do. The session's Arrow batches are
    brought down to ARROW_ROWS rows if they are larger.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    target = os.path.join(tempfile.mkdtemp(prefix="stratum-ship-"), "stratum.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: lineage ends
    at files every executor can reach, so a lost executor costs no recompute."""
    path = scratch_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def range_width(spark: SparkSession, n_bytes: int | None, range_bytes: int) -> int:
    """Ranges of ``range_bytes`` for ``n_bytes``, ``spark.sql.shuffle.partitions`` at least."""
    return max(shuffle_width(spark), -(-(n_bytes or 0) // range_bytes))


def plainly_named(rows: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """``rows`` with every column but ``base`` under a name that no operator uses; undo
    with ``toDF(*rows.columns)``. So an operator's own columns never meet the caller's."""
    return rows.toDF(*(c if c in base else f"caller_column_{k}" for k, c in enumerate(rows.columns)))
