"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every operator relies on.
SQL_SETTINGS = {
    # Calendar dates are UTC dates.
    "spark.sql.session.timeZone": "UTC",
    # Bad casts and divisions by zero raise unless an operator uses try_*.
    "spark.sql.ansi.enabled": "true",
    # Re-plan at run time: coalesce small shuffle partitions, split hot ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Size of the pieces a rebalanced write is cut into, hence of the files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Stream state lives in RocksDB on the executors' disks, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

SCRATCH_SETTING = "spark.checkpoint.dir"

# Temporary folders of local sessions that name none, by application.
_local_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SQL_SETTINGS` to a running session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "rookery",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session carrying :data:`SQL_SETTINGS`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables, as named by the cluster.

    A single-machine session without the setting gets a temporary folder, once
    per session.  On a cluster the setting is required: a folder that only one
    machine sees does not survive the loss of that machine.
    """
    root = spark.conf.get(SCRATCH_SETTING, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError(f"set {SCRATCH_SETTING} to a folder all executors share")
        application = spark.conf.get("spark.app.id")
        root = _local_roots.get(application) or tempfile.mkdtemp(prefix="rookery-")
        _local_roots[application] = root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
