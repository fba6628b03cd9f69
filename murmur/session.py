"""Session settings the jobs rely on, and the shared folder for scratch tables."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Results depend on the first; the rest are how the plans are meant to run.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
CHECKPOINT_DIR = "spark.checkpoint.dir"


def build(master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName("murmur")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_dir() -> tempfile.TemporaryDirectory:
    """Folder of a local session, removed when Python ends."""
    return tempfile.TemporaryDirectory(prefix="murmur-", ignore_cleanup_errors=True)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, as in
    tests, may go without and gets a temporary folder.
    """
    set_to = spark.conf.get(CHECKPOINT_DIR, None)
    if set_to:
        return set_to.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    return _local_dir().name


def scratch(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
