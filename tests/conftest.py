from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    warehouse = tempfile.mkdtemp(prefix="stratum-wh-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("stratum-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "4KB")
        .config("spark.sql.warehouse.dir", warehouse)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="stratum-ckpt-"))
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="stratum-test-")


def rows(df, *cols):
    """Collected rows as tuples (optionally of some columns), in input order."""
    if cols:
        df = df.select(*cols)
    return [tuple(r) for r in df.collect()]
