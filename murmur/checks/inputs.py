"""Canonical inputs derived from the given tables, in Spark and in SQL.

Documents become articles of eight sites in two vocabularies and four date
formats, conversations become posts with comments, events become messages and
crawl events.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.operators.joins import literal_table

AS_OF = dt.date(2024, 1, 31)

STOPWORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "was", "on", "with", "be",
    "de", "la", "le", "les", "des", "et", "un", "en", "que", "el", "der", "die", "und", "den",
)

# Word, category, place of definition; "que" and "as" are defined twice.
LEXICON = (
    ("by", "喜悅", 1),
    ("this", "期待", 2),
    ("are", "支持", 3),
    ("from", "驚訝", 4),
    ("at", "生氣", 5),
    ("an", "失望", 6),
    ("que", "喜悅", 7),
    ("as", "質疑", 8),
    ("von", "擔憂", 9),
    ("un", "謝謝", 10),
    ("es", "不滿", 11),
    ("den", "有趣", 12),
    ("les", "焦慮", 13),
    ("el", "成功", 14),
    ("que", "反感", 15),
    ("the", "安心", 16),
    ("with", "後悔", 17),
    ("as", "願意", 18),
)

GAZETTEER = (("tion", "ORG"), ("ing", "PERSON"), ("orre", "GPE"), ("die", "NORP"), ("ea", "LOC"))

# Names of several words that overlap each other and the single ones; "of the" has two types.
NAMES = (
    *GAZETTEER,
    ("of the", "ORG"), ("of the", "GPE"), ("the and", "FAC"), ("and the", "FAC"), ("is the", "LOC"),
    ("and of the", "EVENT"), ("the of the", "LAW"), ("of the and", "WORK"), ("in der", "GPE"), ("der die", "ORG"),
    ("de la", "GPE"), ("la  de", "LOC"), ("de la de", "ORG"), ("que de", "NORP"), ("de que", "NORP"),
)


# Where the articles of each of the eight sites live.
HOSTS = (
    "https://www.ptt.cc/bbs/b/M.",
    "https://www.dcard.tw/f/b/p/",
    "https://www.ETtoday.net/news/",
    "https://tw.news.yahoo.com/",
    "https://www.setn.com/News/",
    "https://udn.com/news/",
    "https://news.ltn.com.tw/",
    "https://*.example/f/",
)
ENDS = (".html", "", "", ".html", "", "", "", "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stopwords(spark: SparkSession) -> DataFrame:
    return literal_table(spark, [(w,) for w in STOPWORDS], ["word"])


def lexicon(spark: SparkSession) -> DataFrame:
    return literal_table(spark, LEXICON, ["word", "category", "seq"])


def gazetteer(spark: SparkSession) -> DataFrame:
    return literal_table(spark, GAZETTEER, ["word", "type"])


def names(spark: SparkSession) -> DataFrame:
    return literal_table(spark, NAMES, ["word", "type"])


def values(rows, names: str) -> str:
    """A literal table in SQL."""
    cells = ", ".join("(" + ", ".join(repr(c) for c in r) + ")" for r in rows)
    return f"(VALUES {cells}) AS t({names})"


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_seq, key, value) documents as a crawler would have stored them."""
    docs = table(spark, sf_dir, "documents")
    n = F.substring("source", 4, 10).cast("int")
    site = F.pmod(n, F.lit(8))
    ident = F.col("doc_id").cast("string")
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), F.pmod("doc_id", F.lit(30)).cast("int"))
    hosts = F.array(*(F.lit(h) for h in HOSTS))
    ends = F.array(*(F.lit(e) for e in ENDS))
    host = F.replace(F.element_at(hosts, site + 1), F.lit("*"), F.col("source"))
    key = F.concat(host, ident, F.element_at(ends, site + 1))
    month_day = F.concat(F.month(day).cast("string"), F.lit("/"), F.dayofmonth(day).cast("string"))
    han_day = F.concat(
        F.year(day).cast("string"), F.lit("年"), F.month(day).cast("string"), F.lit("月"),
        F.dayofmonth(day).cast("string"), F.lit("日"),
    )
    iso = F.date_format(day, "yyyy-MM-dd")
    board = site <= 1
    value = F.struct(
        F.when(board, F.col("text")).alias("內容"),
        F.when(~board, F.col("text")).alias("content"),
        F.when(site == 0, month_day).alias("發佈日期"),
        F.when(site == 1, F.concat(iso, F.lit("T08:30:00.000Z"))).alias("發布時間"),
        F.when(site == 2, han_day)
        .when(site == 3, F.concat(iso, F.lit(" 08:30:00")))
        .when(site > 3, iso)
        .alias("date"),
        F.when(board, F.concat(F.lit("題 "), ident)).alias("標題"),
        F.when(~board, F.concat(F.lit("title "), ident)).alias("title"),
        F.when(board, F.col("source")).alias("作者"),
        F.when(~board, F.col("source")).alias("reporter"),
    )
    return docs.select(F.col("doc_id").alias("doc_seq"), key.alias("key"), value.alias("value"))


RAW = """
raw AS (
  SELECT doc_id AS doc_seq, text, source AS author,
         CAST(substr(source, 4) AS INTEGER) % 8 AS site,
         DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS day,
         CASE CAST(substr(source, 4) AS INTEGER) % 8
           WHEN 0 THEN 'https://www.ptt.cc/bbs/b/M.' || doc_id || '.html'
           WHEN 1 THEN 'https://www.dcard.tw/f/b/p/' || doc_id
           WHEN 2 THEN 'https://www.ETtoday.net/news/' || doc_id
           WHEN 3 THEN 'https://tw.news.yahoo.com/' || doc_id || '.html'
           WHEN 4 THEN 'https://www.setn.com/News/' || doc_id
           WHEN 5 THEN 'https://udn.com/news/' || doc_id
           WHEN 6 THEN 'https://news.ltn.com.tw/' || doc_id
           ELSE 'https://' || source || '.example/f/' || doc_id
         END AS key
  FROM documents)
"""

# Every site writes its own date format, so the day itself is what a parser must find.
ARTICLES = RAW + """,
articles AS (
  SELECT doc_seq, key AS url, text AS content, author, day AS publish_date, site,
         CASE site WHEN 0 THEN 'PTT' WHEN 1 THEN 'Dcard' WHEN 2 THEN 'ETtoday' WHEN 3 THEN 'Yahoo'
                   WHEN 4 THEN '三立新聞網' WHEN 5 THEN '聯合新聞網' WHEN 6 THEN '自由時報'
                   ELSE '其他新聞網' END AS source
  FROM raw WHERE text IS NOT NULL AND text <> '')
"""

TOKENS = ARTICLES + r""",
split AS (
  SELECT doc_seq, publish_date, source, url,
         regexp_extract_all(lower(content), '[\p{L}\p{M}\p{N}]+') AS w
  FROM articles),
tokens AS (
  SELECT doc_seq, publish_date, source, url, unnest(w) AS token, CAST(unnest(range(len(w))) AS INTEGER) AS pos
  FROM split)
"""

STOP = f"stop AS (SELECT word FROM {values([(w, ) for w in STOPWORDS], 'word').replace(',)', ')')})"
LEX = f"""lex AS (
  SELECT word, arg_max(category, seq) AS category
  FROM {values(LEXICON, 'word, category, seq')} GROUP BY word)"""


def pol_sql() -> str:
    from murmur.functions.fixed import POLARITY

    return f"pol AS (SELECT category, CAST(polarity AS BIGINT) AS polarity FROM {values(POLARITY, 'category, polarity')})"


POL = pol_sql()
GAZ = f"gaz AS (SELECT word, type FROM {values(GAZETTEER, 'word, type')})"


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per conversation, its first turn."""
    conv = table(spark, sf_dir, "conversations").filter("turn = 0")
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), F.pmod("conv_id", F.lit(30)).cast("int"))
    return conv.select(
        F.concat(F.lit("https://www.ptt.cc/bbs/c/M."), F.col("conv_id").cast("string")).alias("url"),
        F.col("text").alias("content"),
        F.col("role").alias("author"),
        day.alias("publish_date"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One comment per later turn; the role stands for the push tag."""
    conv = table(spark, sf_dir, "conversations").filter("turn > 0")
    tag = F.when(F.col("role") == "user", "推").when(F.col("role") == "assistant", "噓")
    ident, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    stamp = F.concat(
        F.lit("10.0."), turn, F.lit(".7 "),
        F.when(F.col("turn") % 3 == 0, F.concat(F.lit("1/"), turn, F.lit(" 12:30")))
        .otherwise(F.concat(F.lit("1/"), turn)),
    )
    time = F.when(F.col("turn") % 4 == 0, "no address").otherwise(stamp)
    return conv.select(
        F.concat(F.lit("https://www.ptt.cc/bbs/c/M."), ident).alias("url"),
        F.col("turn").cast("bigint").alias("pos"),
        F.concat(F.lit("B"), turn).alias("comment_id"),
        tag.alias("tag"),
        F.col("role").alias("user"),
        F.col("text").alias("content"),
        time.alias("time"),
    )


POSTS = """
posts AS (
  SELECT 'https://www.ptt.cc/bbs/c/M.' || conv_id AS url, text AS content, role AS author,
         DATE '2024-01-01' + CAST(conv_id % 30 AS INTEGER) AS publish_date
  FROM conversations WHERE turn = 0),
comments AS (
  SELECT 'https://www.ptt.cc/bbs/c/M.' || conv_id AS url, turn AS pos, 'B' || turn AS comment_id,
         CASE role WHEN 'user' THEN '推' WHEN 'assistant' THEN '噓' END AS tag,
         role AS "user", text AS content,
         CASE WHEN turn % 4 = 0 THEN 'no address'
              ELSE '10.0.' || turn || '.7 1/' || turn || CASE WHEN turn % 3 = 0 THEN ' 12:30' ELSE '' END
         END AS time
  FROM conversations WHERE turn > 0)
"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message envelopes; some values are cut off and some keys are missing."""
    e = table(spark, sf_dir, "events")
    props = F.col("props")
    cut = F.substring("props", 1, 4)
    return e.select(
        F.col("event_type").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.when(F.col("event_id") % 89 != 0, F.col("user_id").cast("string")).alias("key"),
        F.when(F.col("event_id") % 97 == 0, cut).otherwise(props).alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


MESSAGES = """
messages AS (
  SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
         CASE WHEN event_id % 89 <> 0 THEN CAST(user_id AS VARCHAR) END AS key,
         CASE WHEN event_id % 97 = 0 THEN substr(props, 1, 4) ELSE props END AS value, ts AS timestamp
  FROM events)
"""


def crawl_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl log: every event but a sign-up is a visit, the cheapest errors failed."""
    e = table(spark, sf_dir, "events").filter("event_type <> 'signup'")
    failed = (F.col("event_type") == "error") & (F.col("value") < 1)
    return e.select(
        F.concat(F.lit("https://www.dcard.tw/f/b/p/"), F.col("user_id").cast("string")).alias("url"),
        F.col("event_id").alias("seq"),
        F.when(failed, "failed").otherwise("ok").alias("kind"),
        F.to_date("ts").alias("date"),
    )


def found_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs as they were discovered: sign-ups, many of them again and again, and pages."""
    e = table(spark, sf_dir, "events").filter("event_type = 'signup'")
    posts = e.select(
        F.concat(F.lit("https://www.dcard.tw/f/b/p/"), F.col("user_id").cast("string")).alias("url"),
        F.to_date("ts").alias("date"),
        F.col("event_id").alias("seq"),
    )
    pages = table(spark, sf_dir, "pages").select(
        "url", F.lit(AS_OF).alias("date"), (-F.col("page_id") - 1).alias("seq")
    )
    return posts.unionByName(pages)


CRAWL = """
crawl AS (
  SELECT 'https://www.dcard.tw/f/b/p/' || user_id AS url, event_id AS seq,
         CASE WHEN event_type = 'error' AND value < 1 THEN 'failed' ELSE 'ok' END AS kind, CAST(ts AS DATE) AS date
  FROM events WHERE event_type <> 'signup'),
found AS (
  SELECT 'https://www.dcard.tw/f/b/p/' || user_id AS url, CAST(ts AS DATE) AS date, event_id AS seq
  FROM events WHERE event_type = 'signup'
  UNION ALL SELECT url, DATE '2024-01-31', -page_id - 1 FROM pages),
seeded AS (
  SELECT string_split(url, '/')[-1] AS id, arg_min(date, seq) AS date, url,
         0 AS first_crawl, CAST(0 AS BIGINT) AS confirm_num, CAST(NULL AS DATE) AS last_update
  FROM found GROUP BY url),
first_fail AS (SELECT url, min(seq) AS failed FROM crawl WHERE kind = 'failed' GROUP BY url),
lived AS (
  SELECT c.*, f.failed FROM crawl c LEFT JOIN first_fail f USING (url)
  WHERE f.failed IS NULL OR c.seq <= f.failed),
states AS (
  SELECT url, 1 AS first_crawl,
         CAST(CASE WHEN max(failed) IS NOT NULL THEN 0 ELSE count(*) END AS BIGINT) AS confirm_num,
         arg_max(date, seq) AS last_update
  FROM lived GROUP BY url)
"""


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, raw): the time of an event in one of ten notations, bad ones too."""
    e = table(spark, sf_dir, "events")
    day, kind = F.to_date("ts"), F.col("event_id") % 10
    y, m, d = (f(day).cast("string") for f in (F.year, F.month, F.dayofmonth))
    raw = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == 1, F.concat(y, F.lit("年"), m, F.lit("月"), d, F.lit("日")))
        .when(kind == 2, F.concat(m, F.lit("/"), d))
        .when(kind == 3, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(kind == 4, F.date_format("ts", "yyyy/MM/dd HH:mm:ss"))
        .when(kind == 5, F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .when(kind == 6, F.concat(F.lit("2023/"), m, F.lit("/"), d))
        .when(kind == 7, F.col("event_type"))
        .when(kind == 8, F.concat(F.lit("2/"), d))
    )
    return e.select("event_id", raw.alias("raw"))


DATES = """
dates AS (
  SELECT event_id, event_id % 10 AS kind, CAST(ts AS DATE) AS day, ts,
         year(ts) AS y, month(ts) AS m, day(ts) AS d,
         CASE event_id % 10
           WHEN 0 THEN strftime(ts, '%Y-%m-%d')
           WHEN 1 THEN year(ts) || '年' || month(ts) || '月' || day(ts) || '日'
           WHEN 2 THEN month(ts) || '/' || day(ts)
           WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')
           WHEN 4 THEN strftime(ts, '%Y/%m/%d %H:%M:%S')
           WHEN 5 THEN strftime(ts, '%Y-%m-%d %H:%M')
           WHEN 6 THEN '2023/' || month(ts) || '/' || day(ts)
           WHEN 7 THEN event_type
           WHEN 8 THEN '2/' || day(ts)
         END AS raw
  FROM events)
"""
