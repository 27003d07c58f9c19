"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Event times are written as zone-less local times and read back as instants; only UTC makes that
# round trip lossless.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}

# Static or start-up settings for sessions this package creates itself.
RECOMMENDED = {
    **REQUIRED,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The streaming queries of the pipeline share the executors evenly, each in its own pool.
    "spark.scheduler.mode": "FAIR",
    # Window and latest-reading state lives off-heap, so the number of sensors is not bound by the
    # executor heap; changelog checkpoints upload only what a batch changed.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "airledger", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session somebody else created."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def work_root(spark: SparkSession) -> str:
    """A fresh directory below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="airledger-")
    return f"{base.rstrip('/')}/run-{uuid.uuid4().hex}"
