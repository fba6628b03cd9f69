"""Messages, stores and report tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from murmur.checks import inputs as src
from murmur.checks.registry import query
from murmur.operators import ingest, keywords, tables
from murmur.operators.tokens import tokenize
from murmur.plans import daily
from murmur.session import scratch
from murmur.sources import io

PROPS = "k bigint"
MSG = src.MESSAGES


@query(f'WITH {MSG} SELECT topic, partition, "offset", key, value FROM messages')
def kafka_envelope(spark, sf):
    # Any file format stands in for the broker; key and value arrive as bytes.
    path = scratch(spark, "messages")
    src.messages(spark, sf).write.parquet(path)
    return io.read_messages(spark, "parquet", path=path).drop("timestamp")


@query(f"""WITH {MSG}
SELECT "offset", TRY_CAST(json_extract_string(value, '$.k') AS BIGINT) AS k
FROM messages WHERE json_valid(value)""")
def json_parse_drop_bad(spark, sf):
    good, _ = ingest.parse_messages(src.messages(spark, sf), PROPS)
    return good.select("offset", F.col("value.k").alias("k"))


LATEST = MSG + """,
last AS (
  SELECT topic, partition, "offset", key, CAST(json_extract_string(value, '$.k') AS BIGINT) AS k FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY timestamp DESC, partition DESC, "offset" DESC) AS r
    FROM messages WHERE json_valid(value)) WHERE r = 1)
"""


@query(f'WITH {LATEST} SELECT topic, partition, "offset", key, k FROM last')
def upsert_latest_by_key(spark, sf):
    good, _ = ingest.parse_messages(src.messages(spark, sf), PROPS)
    last = ingest.latest_by_key(good, ["key"], ["timestamp", "partition", "offset"])
    return last.select("topic", "partition", "offset", "key", F.col("value.k").alias("k"))


# Values that end too early or too late; a name given twice and other types are none of these.
ENDINGS = ("]", "]x", "],[2", "} ", " x", ",", "")
BROKEN = MSG + ", broken AS (SELECT \"offset\", value || CASE CAST(\"offset\" % 9 AS INTEGER) " + " ".join(
    f"WHEN {i} THEN '{e}'" for i, e in enumerate(ENDINGS)
) + " ELSE '' END AS value FROM messages)"


@query(f"""WITH {BROKEN}
SELECT "offset", TRY_CAST(json_extract_string(value, '$.k') AS BIGINT) AS k
FROM broken WHERE json_valid(value)""")
def json_one_value_to_its_end(spark, sf):
    ends = F.element_at(F.array(*(F.lit(e) for e in ENDINGS), F.lit(""), F.lit("")), (F.col("offset") % 9 + 1).cast("int"))
    rows = src.messages(spark, sf).withColumn("value", F.concat("value", ends))
    good, _ = ingest.parse_messages(rows, PROPS)
    return good.select("offset", F.col("value.k").alias("k"))


# Messages that give some fields only: every third has no ``k``, every fifth sets ``s`` to null, others leave it out.
FIELDS = "k bigint, s string, n bigint"
PARTIAL = MSG + """,
partial AS (
  SELECT topic, partition, "offset", key, timestamp, "offset" % 3 <> 0 AS has_k, "offset" % 2 = 0 OR "offset" % 5 = 0 AS has_s,
         "offset" % 7 = 0 AS has_n, CAST(json_extract_string(value, '$.k') AS BIGINT) AS k,
         CASE WHEN "offset" % 5 <> 0 THEN topic END AS s, "offset" AS n
  FROM messages WHERE json_valid(value))
"""


def partial_messages(spark, sf):
    """Messages whose values name some of the fields."""
    good, _ = ingest.parse_messages(src.messages(spark, sf), PROPS)
    at = F.col("offset")
    parts = F.array(
        F.when(at % 3 != 0, F.concat(F.lit('"k":'), F.coalesce(F.col("value.k").cast("string"), F.lit("null")))),
        F.when(at % 5 == 0, F.lit('"s":null')).when(at % 2 == 0, F.concat(F.lit('"s":"'), "topic", F.lit('"'))),
        F.when(at % 7 == 0, F.concat(F.lit('"n":'), at.cast("string"))),
    )
    return good.withColumn("value", F.concat(F.lit("{"), F.array_join(F.array_compact(parts), ","), F.lit("}")))


MERGED = PARTIAL + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY timestamp DESC, partition DESC, "offset" DESC) AS r FROM partial),
merged AS (
  SELECT key, arg_min(struct_pack(t := topic, p := partition, o := "offset"), r) AS last,
         arg_min(struct_pack(v := k), r) FILTER (has_k) AS k, arg_min(struct_pack(v := s), r) FILTER (has_s) AS s,
         arg_min(struct_pack(v := n), r) FILTER (has_n) AS n
  FROM ranked GROUP BY key)
"""


@query(f'WITH {MERGED} SELECT key, last.t AS topic, last.p AS partition, last.o AS "offset", k.v AS k, s.v AS s, n.v AS n FROM merged')
def upsert_fields_by_key(spark, sf):
    merged = ingest.merge_fields_by_key(partial_messages(spark, sf), FIELDS, ["key"], ["timestamp", "partition", "offset"])
    return merged.select("key", "topic", "partition", "offset", "value.*")


@query(f"""WITH {MSG} SELECT topic, partition, "offset", key, value FROM messages
UNION ALL SELECT topic, partition, "offset", key, value FROM messages WHERE topic = 'error'""")
def append_messages(spark, sf):
    path = scratch(spark, "append")
    rows = src.messages(spark, sf).drop("timestamp")
    io.write_append(rows, path)
    io.write_append(rows.filter("topic = 'error'"), path)
    return spark.read.parquet(path)


@query("""SELECT CAST(event_id AS VARCHAR) AS key, event_id, user_id, event_type, value, ts,
  CASE WHEN event_type = 'error' THEN NULL ELSE props END AS props, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS has_null
FROM events""")
def kafka_sink(spark, sf):
    props = F.when(F.col("event_type") != "error", F.col("props"))
    rows = src.table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", "ts", props.alias("props")
    )
    sent = ingest.to_messages(rows, "event_id")
    back = F.from_json("value", "event_id bigint, user_id bigint, event_type string, value double, ts timestamp_ntz, props string", ingest.MICROS)
    kept = F.col("value").contains('"props":null').cast("int")
    return sent.select("key", kept.alias("has_null"), back.alias("v")).select("key", "v.*", "has_null")


@query("SELECT url, html FROM pages")
def collection_scan(spark, sf):
    return io.scan(spark, f"{sf}/pages.parquet", ["url", "html"])


@query("SELECT page_id, url, html FROM pages")
def collection_copy(spark, sf):
    path = scratch(spark, "copy")
    pages = src.table(spark, sf, "pages")
    io.copy(pages.withColumn("_id", F.sha2("url", 256)), path)
    return spark.read.parquet(path)


@query("SELECT CAST(doc_id AS VARCHAR) AS id, source AS title, text AS content FROM documents")
def json_file_scan(spark, sf):
    # Files of one JSON array each, a thousand posts to a file.
    path = scratch(spark, "posts")
    file = F.floor(F.col("doc_id") / 1000).alias("file")
    post = F.to_json(
        F.struct(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("title"), F.col("text").alias("content"))
    )
    w = Window.partitionBy("file").orderBy("doc_id")
    lines = src.table(spark, sf, "documents").select("doc_id", file, post.alias("post")).select(
        "file",
        F.concat(
            F.when(F.lag("doc_id").over(w).isNull(), "[").otherwise(","),
            "post",
            F.when(F.lead("doc_id").over(w).isNull(), "]").otherwise(""),
        ).alias("value"),
    )
    lines.write.partitionBy("file").text(path)
    return io.read_posts(spark, path).select("id", "title", "content")


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def report_export(spark, sf):
    path = scratch(spark, "report")
    events = src.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    io.export_csv(events, path)
    return spark.read.schema(events.schema).options(header=True, escape='"', **ingest.MICROS).csv(path)


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def table_overwrite(spark, sf):
    path = scratch(spark, "table")
    events = src.table(spark, sf, "events")
    io.overwrite(events.select("event_type", F.lit(0).cast("bigint").alias("n")), path)
    io.overwrite(events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.parquet(path)


def _reports(spark, sf):
    """Keyword reports of articles and, for the same days, of board posts."""
    stop = src.stopwords(spark)
    old = daily.daily_keywords(src.raw_documents(spark, sf), stop, src.AS_OF)
    posts = src.posts(spark, sf).select("publish_date", F.lit("PTT").alias("source"), "content")
    counts = keywords.keyword_counts(tokenize(posts, keywords.GROUP))
    return old, keywords.top_keywords(keywords.valid_keywords(counts, stop))


@query(f"""WITH {src.TOKENS}, {src.STOP}, {src.POSTS.strip()},
c AS (SELECT publish_date, source, token AS keyword, count(*) AS cnt FROM tokens
      WHERE token NOT IN (SELECT word FROM stop) GROUP BY ALL),
old AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY publish_date, source ORDER BY cnt DESC, keyword) AS rank FROM c)
        WHERE rank <= 15),
pt AS (SELECT publish_date, 'PTT' AS source, unnest(regexp_extract_all(lower(content), '[\\p{{L}}\\p{{M}}\\p{{N}}]+')) AS keyword FROM posts),
pc AS (SELECT publish_date, source, keyword, count(*) AS cnt FROM pt WHERE keyword NOT IN (SELECT word FROM stop) GROUP BY ALL),
new AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY publish_date, source ORDER BY cnt DESC, keyword) AS rank FROM pc)
        WHERE rank <= 15)
SELECT publish_date, source, CAST(rank AS INTEGER) AS rank, keyword, cnt FROM new
UNION ALL
SELECT publish_date, source, CAST(rank AS INTEGER), keyword, cnt FROM old
WHERE (publish_date, source, rank) NOT IN (SELECT (publish_date, source, rank) FROM new)""")
def table_upsert(spark, sf):
    old, new = _reports(spark, sf)
    return tables.upsert(old, new, ["publish_date", "source", "rank"])


@query(f"""WITH {src.CRAWL},
visited AS (SELECT url, min(seq) AS seq, arg_min(date, seq) AS date FROM crawl GROUP BY url),
new AS (SELECT url, min(seq) AS seq, arg_min(date, seq) AS date FROM found GROUP BY url)
SELECT * FROM visited UNION ALL SELECT * FROM new WHERE url NOT IN (SELECT url FROM visited)""")
def insert_ignore(spark, sf):
    visited = ingest.first_by_key(
        src.crawl_events(spark, sf).select("url", "seq", "date"), ["url"], ["seq"]
    )
    return tables.insert_ignore(visited, src.found_urls(spark, sf), ["url"], ["seq"])


@query(f"""WITH {MSG}
SELECT 'accepted' AS verdict, CAST("offset" AS VARCHAR) AS id, 1 AS n FROM messages WHERE key IS NOT NULL AND value <> ''
UNION ALL SELECT 'rejected', CAST("offset" AS VARCHAR), 1 FROM messages WHERE key IS NULL OR value IS NULL OR value = ''
UNION ALL SELECT 'duplicate', topic || ' ' || key, count(*) FROM messages WHERE key IS NOT NULL GROUP BY topic, key HAVING count(*) > 1""")
def validate_rows(spark, sf):
    rows = src.messages(spark, sf)
    ok, bad = tables.validate(rows, ["topic", "key", "value"], ["key"], ["value"])
    twice = tables.duplicate_keys(rows.filter("key is not null"), ["topic", "key"])
    offset, one = F.col("offset").cast("string").alias("id"), F.lit(1).cast("bigint").alias("n")
    return (
        ok.select(F.lit("accepted").alias("verdict"), offset, one)
        .unionAll(bad.select(F.lit("rejected"), offset, one))
        .unionAll(twice.select(F.lit("duplicate"), F.concat_ws(" ", "topic", "key"), "n"))
    )


@query(f"""WITH {src.RAW}, {src.POSTS.strip()}
SELECT key AS url, 'article' AS kind, text AS content, CAST(NULL AS VARCHAR) AS html FROM raw
UNION ALL SELECT url, 'post', content, NULL FROM posts
UNION ALL SELECT url, 'page', NULL, html FROM pages""")
def multi_source_union(spark, sf):
    raw = src.raw_documents(spark, sf).select(
        F.col("key").alias("url"),
        F.lit("article").alias("kind"),
        F.coalesce("value.內容", "value.content").alias("content"),
    )
    posts = src.posts(spark, sf).select("url", F.lit("post").alias("kind"), "content")
    pages = src.table(spark, sf, "pages").select("url", F.lit("page").alias("kind"), "html")
    return tables.union_sources(raw, posts, pages)
