"""News messages to documents with entities and word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from murmur.functions.counts import occurrences
from murmur.functions.text import clean_text, tokens
from murmur.operators.ingest import latest_by_key, parse_messages
from murmur.operators.joins import small_lookup
from murmur.operators.tokens import token_rows
from murmur.streaming.ingest import KEYS, ORDER
from murmur.streaming.log import put, start

NEWS_VALUE = "url string, title string, reporter string, content string, date string"


def enrich(messages: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Latest message per key with cleaned content, entities and word counts."""
    good, _ = parse_messages(messages, NEWS_VALUE)
    last = latest_by_key(good, KEYS, ORDER)
    docs = last.select(
        # The key may be missing: a document is known by its place in the log.
        F.struct("topic", "partition", "offset").alias("_doc"),
        "key",
        "timestamp",
        F.col("value.date").alias("publish_date"),
        "value.title",
        F.col("value.reporter").alias("author"),
        clean_text(F.coalesce("value.content", F.lit(""))).alias("content"),
    )
    # Words are counted in their document; only those that the gazetteer names become rows that are moved.
    words = tokens(F.col("content"), lower=False)
    names = gazetteer.select(F.col("word").alias("token"), "type").groupBy("token").agg(
        F.sort_array(F.collect_set("type")).alias("_types")
    )
    named = small_lookup(token_rows(docs.select("_doc", words.alias("_words")), ["_doc"], "_words"), names, ["token"])
    found = F.transform("_types", lambda t: F.struct("pos", F.col("token").alias("word"), t.alias("type")))
    by_doc = named.select("_doc", found.alias("_found")).groupBy("_doc").agg(
        F.sort_array(F.flatten(F.collect_list("_found"))).alias("_mentions")
    )
    entities = F.transform("_mentions", lambda e: F.struct(e["word"].alias("word"), e["type"].alias("type")))
    counts = F.map_from_entries(occurrences(words))
    none = F.array().cast("array<struct<word: string, type: string>>")
    return docs.join(by_doc, "_doc", "left").select(
        "key",
        "_doc.topic",
        "_doc.partition",
        "_doc.offset",
        "timestamp",
        "publish_date",
        "title",
        "author",
        "content",
        F.coalesce(entities, none).alias("entities"),
        counts.alias("word_frequency"),
    )


def enrich_stream(
    messages: DataFrame, gazetteer: DataFrame, table: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """The same, batch by batch; read the result with ``read_collection``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            put(enrich(batch, gazetteer), table, batch_id)
        finally:
            batch.unpersist()

    return start(messages, write, checkpoint, trigger=trigger)
