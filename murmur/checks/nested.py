"""Comment threads and other nested documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.checks import inputs as src
from murmur.checks.registry import query
from murmur.operators import comments as com
from murmur.operators.articles import normalize_for_annotation

CLEAN = r"""trim(regexp_replace(regexp_replace(regexp_replace(content, '\n+', chr(10), 'g'),
  '-----\nSent from[^\n]*', '', 'g'), '--+', '', 'g'), ' ' || chr(9) || chr(10) || chr(13) || chr(160) || '　')"""


def _nested(spark, sf, keep_empty=True):
    return com.nest_comments(src.comments(spark, sf), src.posts(spark, sf), keep_empty)


@query(f"""WITH {src.POSTS}
SELECT url, row_number() OVER (PARTITION BY url ORDER BY pos) - 1 AS pos, tag, "user", content, time FROM comments""")
def explode_comments_struct(spark, sf):
    zh = F.transform(
        "comments",
        lambda c: F.struct(
            c["tag"].alias("推文"), c["user"].alias("用戶"), c["content"].alias("內容"), c["time"].alias("時間")
        ),
    )
    posts = _nested(spark, sf).select("url", zh.alias("留言"))
    return com.explode_comments(posts, "留言").drop("comment_id")


@query(f"""WITH {src.POSTS},
c AS (
  SELECT c.url, row_number() OVER (PARTITION BY c.url ORDER BY pos) - 1 AS pos, comment_id, "user",
         {CLEAN.replace('content', 'c.content')} AS content,
         CASE WHEN pos % 2 = 0 THEN CAST(publish_date AS VARCHAR) ELSE time END AS time
  FROM comments c JOIN posts p ON c.url = p.url)
SELECT * FROM c WHERE content <> ''""")
def explode_comments_map(spark, sf):
    floors = F.transform(
        "comments",
        lambda c: F.create_map(
            c["comment_id"],
            F.struct(
                c["user"].alias("用戶"),
                c["content"].alias("內容"),
                F.when(c["pos"] % 2 != 0, c["time"]).alias("時間"),
            ),
        ),
    )
    posts = _nested(spark, sf).select("url", "publish_date", floors.alias("留言"))
    return com.explode_comment_maps(posts, "留言").drop("tag")


@query(f"""WITH {src.POSTS}
SELECT p.url, p.author, count(c.url) AS n, CAST(coalesce(sum(length(c.content)), 0) AS BIGINT) AS chars,
  coalesce(string_agg(c.comment_id, ',' ORDER BY c.pos), '') AS floors
FROM posts p LEFT JOIN comments c ON p.url = c.url GROUP BY ALL""")
def nest_comments(spark, sf):
    sizes = F.transform("comments", lambda c: F.length(c["content"]).cast("bigint"))
    return _nested(spark, sf).select(
        "url",
        "author",
        F.size("comments").cast("bigint").alias("n"),
        F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("chars"),
        F.array_join("comments.comment_id", ",").alias("floors"),
    )


def _crawls(spark, sf):
    """An early crawl that saw what users wrote, and a later one that saw it all."""
    new = src.comments(spark, sf)
    return new.filter(F.col("user") == "user"), new


MERGE = (
    src.POSTS
    + """,
old AS (SELECT * FROM comments WHERE "user" = 'user'),
fresh AS (
  SELECT * FROM comments n WHERE NOT EXISTS (
    SELECT 1 FROM old o WHERE o.url = n.url AND o.tag IS NOT DISTINCT FROM n.tag
      AND o."user" IS NOT DISTINCT FROM n."user" AND o.content IS NOT DISTINCT FROM n.content
      AND o.time IS NOT DISTINCT FROM n.time))
"""
)


@query(f"WITH {MERGE} SELECT url, pos, tag, \"user\", content, time FROM fresh")
def new_comment_difference(spark, sf):
    old, new = _crawls(spark, sf)
    return com.new_comments(old, new).select("url", "pos", "tag", "user", "content", "time")


@query(f"""WITH {MERGE},
ends AS (SELECT url, max(pos) + 1 AS e FROM old GROUP BY url)
SELECT url, pos, tag, "user", content, time FROM old
UNION ALL SELECT f.url, row_number() OVER (PARTITION BY f.url ORDER BY f.pos) - 1 + coalesce(e, 0), tag, "user", content, time
FROM fresh f LEFT JOIN ends USING (url)""")
def merge_comments(spark, sf):
    return com.merge_comments(*_crawls(spark, sf)).drop("comment_id")


@query(f"""WITH {src.POSTS},
bad AS (SELECT url, min(pos) AS b FROM comments WHERE tag IS NULL GROUP BY url)
SELECT p.url, count(*) FILTER (tag = '推' AND (b IS NULL OR pos < b)) AS push,
       count(*) FILTER (tag = '噓' AND (b IS NULL OR pos < b)) AS boo,
       count(*) FILTER (tag NOT IN ('推', '噓') AND (b IS NULL OR pos < b)) AS arrow
FROM posts p LEFT JOIN comments c ON p.url = c.url LEFT JOIN bad ON p.url = bad.url GROUP BY p.url""")
def push_counts(spark, sf):
    return com.push_counts(src.comments(spark, sf), src.posts(spark, sf))


@query(f"""WITH {src.POSTS}, n AS (SELECT url, count(*) AS n FROM comments GROUP BY url)
SELECT url, CAST(0 AS BIGINT) AS chunk_no, CAST(1 AS BIGINT) AS chunks, 'ptt' AS source, publish_date, author, {CLEAN} AS content, n
FROM posts JOIN n USING (url)""")
def thread_envelope(spark, sf):
    raw = src.posts(spark, sf).select(
        F.col("url").alias("key"),
        F.struct(
            F.col("content").alias("post"),
            F.date_format("publish_date", "yyyy/M/d").alias("date"),
            "author",
        ).alias("value"),
    )
    articles = normalize_for_annotation(raw)
    nested = com.nest_comments(src.comments(spark, sf), articles, keep_empty=False)
    docs = com.thread_envelope(nested, "ptt")
    return docs.select(
        "url", "chunk_no", "data.chunks", "data.source", "data.publish_date", "data.author", "data.content",
        F.size("data.comments").cast("bigint").alias("n"),
    )


@query("""WITH e AS (SELECT user_id, event_type, count(*) AS c FROM events GROUP BY ALL)
SELECT user_id, event_type AS emoji, CASE WHEN c % 5 <> 0 THEN c END AS n,
  CAST(CASE WHEN sum(c) OVER (PARTITION BY user_id) % 7 <> 0 THEN sum(c) OVER (PARTITION BY user_id) ELSE 0 END AS BIGINT) AS total
FROM e""")
def emoji_counts(spark, sf):
    # Per user, how often each event type came up, as the text of a popup; some counts are no numbers.
    events = src.table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    shown = F.when(F.col("n") % 5 != 0, F.col("n").cast("string")).otherwise("many")
    lines = F.collect_list(F.concat("event_type", F.lit("\n"), shown))
    all_of = F.sum("n")
    users = events.groupBy("user_id").agg(
        F.array_join(lines, "\n").alias("popup"),
        F.when(all_of % 7 != 0, all_of.cast("string")).otherwise("many").alias("shown"),
    )
    users = users.select("user_id", F.array(com.emoji_map(F.col("popup"))).alias("emoji_type"), com.emoji_total(F.col("shown")).alias("total"))
    found = com.emoji_counts(users, url="user_id").withColumnRenamed("url", "user_id")
    return found.join(users.select("user_id", "total"), "user_id")
