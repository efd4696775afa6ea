"""Skew and retry behaviour of the sinks, observed rather than assumed."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

from pyspark.sql import functions as F

from stratum.sinks import overwrite_table
from stratum.sinks.staged import described

from conftest import ROOT


def test_hot_date_is_split_across_writers(spark, tmp_dir):
    """A date holding a third of the rows is written by several tasks, not one."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("2026-01-01"))
        .otherwise(F.date_format(F.date_add(F.lit("2026-02-01"), (F.col("id") % 60).cast("int")), "yyyy-MM-dd"))
        .cast("date").alias("deposit_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        overwrite_table(df, "t_hot_date", partition_by="deposit_date", path=tmp_dir + "/hot")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    at = described(spark, "t_hot_date")["Location"].removeprefix("file:")
    hot = [f for f in os.listdir(at + "/deposit_date=2026-01-01") if f.endswith(".parquet")]
    assert len(hot) > 1
    assert spark.table("t_hot_date").count() == n


RETRY_SCRIPT = textwrap.dedent(
    """
    import sys, tempfile
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from stratum.sinks import append_table

    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    @F.udf("boolean")
    def flaky(_):
        # every task fails on its first attempt (stands in for a lost executor)
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("injected failure")
        return True

    df = spark.range(0, 4000, numPartitions=4).where(flaky("id"))
    d = tempfile.mkdtemp()
    n = append_table(df, "t_retry", path=d + "/t", count=True)
    print("OBSERVED", n, spark.table("t_retry").count())
    m = append_table(df.groupBy((F.col("id") % 7).alias("k")).count(), "t_retry2", path=d + "/t2",
                     count=True, partition_by="k")
    print("OBSERVED2", m, spark.table("t_retry2").count())
    """
)


def test_counts_exact_when_tasks_are_retried(tmp_dir):
    script = os.path.join(tmp_dir, "retry.py")
    with open(script, "w") as f:
        f.write(RETRY_SCRIPT.format(root=ROOT))
    out = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600)
    lines = [line for line in out.stdout.splitlines() if line.startswith("OBSERVED")]
    assert lines, out.stderr[-2000:]
    assert lines[0].split()[1:] == ["4000", "4000"]
    assert lines[1].split()[1:] == ["7", "7"]
