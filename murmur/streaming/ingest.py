"""Messages to a collection that holds the latest document per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from murmur.operators.ingest import field_winners, latest_by_key, merge_fields_by_key, parse_messages, split_messages
from murmur.streaming.log import put, read_latest, start

KEYS = ("key",)
# By arrival: messages without a key lie in all partitions.
ORDER = ("timestamp", "partition", "offset")


def ingest_stream(
    messages: DataFrame,
    schema: str,
    table: str,
    quarantine: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Upsert messages by key; values that are no JSON go to ``quarantine``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = parse_messages(batch, schema)
            put(latest_by_key(good, KEYS, ORDER), table, batch_id)
            put(bad, quarantine, batch_id)
        finally:
            batch.unpersist()

    return start(messages, write, checkpoint, trigger=trigger)


def ingest_fields_stream(
    messages: DataFrame,
    schema: str,
    table: str,
    quarantine: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Upsert messages by key and field: a batch leaves the messages that any field comes from; read with ``read_fields``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = split_messages(batch)
            put(field_winners(good, schema, KEYS, ORDER), table, batch_id)
            put(bad, quarantine, batch_id)
        finally:
            batch.unpersist()

    return start(messages, write, checkpoint, trigger=trigger)


def read_fields(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """Documents of a log that ``ingest_fields_stream`` writes."""
    return merge_fields_by_key(spark.read.parquet(table).drop("batch_id"), schema, KEYS, ORDER)


def append_stream(
    messages: DataFrame, table: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep every message, equal ones included."""
    return (
        messages.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(table)
    )


def read_collection(spark: SparkSession, table: str) -> DataFrame:
    return read_latest(spark, table, KEYS, ORDER)
