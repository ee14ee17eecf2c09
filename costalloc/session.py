"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; cluster sizing is left to the submitter.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The allocation join turns few bytes into many rows; small inputs must not
    # be squeezed into one task before it. No effect on large partitions.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # State of streams outgrows the heap; it is kept on disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# For writes: shuffle files go when the action that made them has ended, not when the driver next collects garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "costalloc", **extra: str) -> SparkSession:
    """A session with the settings above. State of streams is kept in RocksDB."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def set_for(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings that hold for some actions, and are as they were afterwards."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can write to, as named by the cluster.

    Only a local session may fall back to a temporary folder of its own.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="costalloc-")
    spark.conf.set(CHECKPOINT_SETTING, made)
    return made


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder."""
    return f"{shared_dir(spark)}/costalloc/{name}-{uuid.uuid4().hex}"


def materialize(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back: later steps start from there, also after an executor is lost."""
    path = run_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
