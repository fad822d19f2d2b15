"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Times are UTC wall clock everywhere.
    "spark.sql.session.timeZone": "UTC",
    # The default, INT96, has no min/max statistics, so time filters would skip nothing.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Defaults for sessions we build ourselves; a submitted job's own settings win.
BUILD_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keep streaming state off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BUILD_SETTINGS, **RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


# One shuffle partition per this much input, but never fewer than the session's setting.
SHUFFLE_BYTES = 256 * 1024 * 1024


def shuffle_partitions_for(rows: DataFrame) -> int:
    """Shuffle partitions that suit the estimated size of ``rows``; never below the setting."""
    conf = rows.sparkSession.conf
    current = int(conf.get("spark.sql.shuffle.partitions"))
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= int(conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1))):
        return current  # not an estimate, but Spark's word for "unknown"
    return max(current, size // SHUFFLE_BYTES)


@contextmanager
def fitted_shuffles(rows: DataFrame) -> Iterator[int]:
    """Run batch work on ``rows`` with as many shuffle partitions as their size calls for.

    The fixed default is far too small for a table of many terabytes. Adaptive execution
    merges what turns out too fine, but it does not add partitions.
    """
    conf = rows.sparkSession.conf
    before = conf.get("spark.sql.shuffle.partitions")
    wanted = shuffle_partitions_for(rows)
    conf.set("spark.sql.shuffle.partitions", str(wanted))
    try:
        yield wanted
    finally:
        conf.set("spark.sql.shuffle.partitions", before)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table, in the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local-mode
    session without the setting falls back to the machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tickloom-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
