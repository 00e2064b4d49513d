"""Session settings the jobs are designed for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LAKE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Sums that overflow must stop a job, not wrap.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet is smaller on disk than in memory; without the factor the size
    # check that allows a broadcast would compare compressed bytes.
    "spark.sql.sources.fileCompressionFactor": "3.0",
}

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app: str = "skyledger",
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings above; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    settings = dict(LAKE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stream_session(spark: SparkSession, *, state_partitions: int | None = None) -> SparkSession:
    """Sibling session (same catalog and executors) with the state-store settings;
    what is set in ``spark`` applies there too and wins.

    The number of state partitions is frozen in a stream's checkpoint at its
    first start, so it is an argument and not inherited by accident.
    """
    sibling = spark.newSession()
    for key, value in {**LAKE_CONF, **STATE_CONF, **spark.conf.getAll}.items():
        if sibling.conf.isModifiable(key):
            sibling.conf.set(key, value)
    partitions = state_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    sibling.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return sibling


def shared_scratch(spark: SparkSession, label: str) -> str:
    """New folder name below the folder the cluster names for checkpoints.

    A machine-local folder is used only in local mode and only when the session
    names none.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="skyledger-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
