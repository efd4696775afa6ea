"""Shared scratch locations.

Anything a job writes to cut lineage or to stage files (CSV drops in the
checks, external tables) goes below the folder the cluster names in
``spark.checkpoint.dir``, never a machine-local temporary folder. Only when the
session has no such setting (a bare test session) do we make one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CONF = "spark.checkpoint.dir"
_LOCAL_FALLBACK: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Root of the shared folder, read from the session.

    Falls back to a fresh local folder (one per application) only when
    ``spark.checkpoint.dir`` is unset in a local-mode session, as in tests;
    on a cluster an unset setting is an error.
    """
    root = spark.conf.get(_CONF, None)
    if not root:
        try:  # classic sessions also carry it in the SparkConf; Connect has no SparkContext
            root = spark.sparkContext.getConf().get(_CONF, None)
        except Exception:
            root = None
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                f"{_CONF} is not set: name a folder on shared storage that every executor can reach"
            )
        # the setting cannot be changed on a running session: keep one folder per application
        app = spark.conf.get("spark.app.id", None) or str(id(spark))
        if app not in _LOCAL_FALLBACK:
            _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="stratum-ckpt-")
        root = _LOCAL_FALLBACK[app]
    return root.rstrip("/")


def _is_local(spark: SparkSession) -> bool:
    """True for a single-machine (``local[...]``) session, where a local folder is shared."""
    try:
        master = spark.conf.get("spark.master", None) or spark.sparkContext.master
    except Exception:
        return False
    return str(master).startswith("local")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique path below the shared root (not created here)."""
    return f"{shared_root(spark)}/stratum/{tag}-{uuid.uuid4().hex[:12]}"


def scratch_table_name(tag: str) -> str:
    """A unique table name in the default database."""
    return f"stratum_{tag}_{uuid.uuid4().hex[:12]}"
