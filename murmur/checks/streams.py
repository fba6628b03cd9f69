"""Streaming jobs, run to the end of their input and compared with plain SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.checks import inputs as src
from murmur.checks.aggregates import SETTLED  # noqa: F401
from murmur.checks.ingest import FIELDS, LATEST, MERGED, PROPS, partial_messages
from murmur.checks.registry import query
from murmur.checks.words import KEYWORDS
from murmur.operators.articles import normalize_for_keywords
from murmur.operators.layout import read_bytes
from murmur.session import scratch
from murmur.sources import io
from murmur.streaming import daily, enrich, ingest

FILES = {"maxFilesPerTrigger": "2"}
PARTS = 4
PART_BYTES = 32 * 1024 * 1024  # of the tables that the rows come from


def _stream(spark, rows, name, parts=PARTS):
    """The rows as a stream of files, a few per micro-batch: its folder, and the options that keep it at two batches.

    Files hold a bounded share of the tables, so that no task writes or reads more of a larger input.
    """
    path = scratch(spark, name)
    parts = max(parts, -(-read_bytes(rows) // PART_BYTES))
    rows.repartition(parts).write.parquet(path)
    return path, FILES if parts == PARTS else {"maxFilesPerTrigger": str(-(-parts // 2))}


@query(f'WITH {LATEST} SELECT topic, partition, "offset", key, k FROM last')
def stream_ingest_upsert(spark, sf):
    path, files = _stream(spark, src.messages(spark, sf), "in")
    source = io.read_messages(spark, "parquet", files, path, stream=True)
    table = scratch(spark, "collection")
    run = ingest.ingest_stream(source, PROPS, table, scratch(spark, "bad"), scratch(spark, "ckpt"))
    run.awaitTermination()
    last = ingest.read_collection(spark, table)
    return last.select("topic", "partition", "offset", "key", F.col("value.k").alias("k"))


@query(f'WITH {MERGED} SELECT key, last.t AS topic, last.p AS partition, last.o AS "offset", k.v AS k, s.v AS s, n.v AS n FROM merged')
def stream_upsert_fields(spark, sf):
    path, files = _stream(spark, partial_messages(spark, sf), "in")
    source = io.read_messages(spark, "parquet", files, path, stream=True)
    table = scratch(spark, "fields")
    ingest.ingest_fields_stream(source, FIELDS, table, scratch(spark, "bad"), scratch(spark, "ckpt")).awaitTermination()
    return ingest.read_fields(spark, table, FIELDS).select("key", "topic", "partition", "offset", "value.*")


@query(f"""WITH {KEYWORDS}
SELECT publish_date, source, CAST(rank AS INTEGER) AS rank, keyword, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY publish_date, source ORDER BY cnt DESC, keyword) AS rank
  FROM kept) WHERE rank <= 15""")
def stream_daily_keywords(spark, sf):
    articles = normalize_for_keywords(src.raw_documents(spark, sf), src.AS_OF).select(
        F.to_date("publish_day").alias("publish_date"), "source", "content"
    )
    path, files = _stream(spark, articles, "articles")
    source = spark.readStream.schema(articles.schema).options(**files).parquet(path)
    table = scratch(spark, "counts")
    daily.daily_keywords_stream(source, table, scratch(spark, "ckpt")).awaitTermination()
    return daily.read_daily_keywords(spark, table, src.stopwords(spark))


@query(f"WITH {src.CRAWL} SELECT url, first_crawl, confirm_num, last_update FROM states")
def stream_frontier(spark, sf):
    events = src.crawl_events(spark, sf)
    path, files = _stream(spark, events, "crawl")
    source = spark.readStream.schema(events.schema).options(**files).parquet(path)
    table = scratch(spark, "frontier")
    daily.frontier_stream(source, table, scratch(spark, "ckpt")).awaitTermination()
    return daily.read_frontier(spark, table)


@query(f"""WITH {src.RAW}, {src.GAZ},
w AS (SELECT key, regexp_extract_all(text, '[\\p{{L}}\\p{{M}}\\p{{N}}]+') AS w FROM raw),
t AS (SELECT key, unnest(w) AS token FROM w),
n AS (SELECT key, count(*) AS n_tokens, count(DISTINCT token) AS n_words FROM t GROUP BY key),
e AS (SELECT key, count(*) AS n_entities FROM t JOIN gaz ON token = word GROUP BY key)
SELECT raw.key, author, CAST(day AS VARCHAR) AS publish_date, coalesce(n_tokens, 0) AS n_tokens,
       coalesce(n_words, 0) AS n_words, coalesce(n_entities, 0) AS n_entities
FROM raw LEFT JOIN n USING (key) LEFT JOIN e USING (key)""")
def stream_enrich(spark, sf):
    raw = src.raw_documents(spark, sf)
    text = F.coalesce("value.內容", "value.content")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_seq", F.lit(30)).cast("int"))
    news = raw.select(
        F.lit("news-topic").alias("topic"),
        F.pmod("doc_seq", F.lit(4)).cast("int").alias("partition"),
        F.col("doc_seq").alias("offset"),
        "key",
        F.to_json(
            F.struct(
                F.col("key").alias("url"),
                text.alias("content"),
                F.coalesce("value.作者", "value.reporter").alias("reporter"),
                day.cast("string").alias("date"),
            )
        ).alias("value"),
    )
    path, files = _stream(spark, news, "news")
    source = io.read_messages(spark, "parquet", files, path, stream=True)
    table = scratch(spark, "enriched")
    enrich.enrich_stream(source, src.gazetteer(spark), table, scratch(spark, "ckpt")).awaitTermination()
    counts = F.map_values("word_frequency")
    return ingest.read_collection(spark, table).select(
        "key",
        "author",
        "publish_date",
        F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n_tokens"),
        F.size("word_frequency").cast("bigint").alias("n_words"),
        F.size("entities").cast("bigint").alias("n_entities"),
    )
