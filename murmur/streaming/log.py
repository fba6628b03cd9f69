"""The change log the streaming jobs share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from murmur.operators.ingest import latest_by_key

# Base of a compacted log: older than any batch.
BASE = -1


def put(rows: DataFrame, table: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")


def start(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Start a checkpointed query; by default it ends when the input is used up."""
    return (
        rows.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )


def read_latest(
    spark: SparkSession, table: str, keys: Sequence[str], order: Sequence[str] = ("batch_id",)
) -> DataFrame:
    """The last row per key, by ``order``."""
    return latest_by_key(spark.read.parquet(table), keys, order).drop("batch_id")


def compact(
    spark: SparkSession, table: str, into: str, keys: Sequence[str], order: Sequence[str] = ("batch_id",)
) -> None:
    """Write the last row per key to a new log, for a restarted job to go on with."""
    put(read_latest(spark, table, keys, order), into, BASE)
