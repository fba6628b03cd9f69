"""Column expressions over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from murmur.checks import inputs as src
from murmur.checks.registry import query
from murmur.functions import dates, html, sites, text
from murmur.functions.fixed import EMOTION_SOURCES
from murmur.operators import articles as art
from murmur.plans.annotation import stamp_comments

# Signatures and rules as board users leave them, put between two copies of a text.
SIGNED = "text || chr(10) || chr(10) || chr(10) || '-----' || chr(10) || 'Sent from my phone' || chr(10) || '-- a --- ' || text || ' '"


@query(f"""WITH d AS (SELECT doc_id, {SIGNED} AS t FROM documents)
SELECT doc_id, trim(
  regexp_replace(regexp_replace(regexp_replace(t, '\\n+', chr(10), 'g'), '-----\\nSent from[^\\n]*', '', 'g'),
                 '--+', '', 'g'), ' ' || chr(9) || chr(10) || chr(13) || '　') AS content FROM d""")
def clean_text(spark, sf):
    nl = F.lit("\n")
    signed = F.concat(
        "text", nl, nl, nl, F.lit("-----"), nl, F.lit("Sent from my phone"), nl, F.lit("-- a --- "), "text", F.lit(" ")
    )
    docs = src.table(spark, sf, "documents").select("doc_id", signed.alias("t"))
    return docs.select("doc_id", text.clean_text(F.col("t")).alias("content"))


@query(f"""WITH {src.ARTICLES}
SELECT doc_seq, url, CASE WHEN site <= 1 THEN '題 ' ELSE 'title ' END || doc_seq AS title, author, content,
       CAST(publish_date AS VARCHAR) AS keyword_day,
       CASE WHEN site = 3 THEN CAST(publish_date AS VARCHAR) || ' 08:30:00' ELSE CAST(publish_date AS VARCHAR) END
         AS emotion_day,
       source FROM articles""")
def normalize_article(spark, sf):
    raw = src.raw_documents(spark, sf)
    by_field = art.reject_incomplete(art.normalize_for_keywords(raw, src.AS_OF))
    by_link = art.normalize_for_emotions(raw).select("doc_seq", F.col("publish_day").alias("emotion_day"))
    return by_field.join(by_link, "doc_seq").select(
        "doc_seq", "url", "title", "author", "content", F.col("publish_day").alias("keyword_day"),
        "emotion_day", "source",
    )


@query("""SELECT conv_id, turn, text AS content FROM conversations
WHERE text IS NOT NULL AND text <> '' AND role IS NOT NULL AND role <> '' AND conv_id % 5 <> 0 AND turn % 3 <> 2 AND conv_id % 7 <> 0""")
def reject_incomplete(spark, sf):
    # Some turns lose their text or their role.
    conv = src.table(spark, sf, "conversations").withColumnRenamed("text", "content").withColumns(
        {
            "content": F.when(F.col("conv_id") % 5 == 0, "").when(F.col("turn") % 3 != 2, F.col("content")),
            "role": F.when(F.col("conv_id") % 7 != 0, F.col("role")),
        }
    )
    return art.reject_incomplete(conv, ("content", "role")).select("conv_id", "turn", "content")


@query(f"""WITH {src.DATES}
SELECT event_id, CASE WHEN kind IN (0, 1, 2, 3, 5) THEN CAST(day AS VARCHAR)
  WHEN kind = 8 THEN '2024-02-' || lpad(CAST(d AS VARCHAR), 2, '0') ELSE '2024-01-31' END AS day FROM dates""")
def date_keyword(spark, sf):
    rows = src.dates(spark, sf)
    none = F.lit(None).cast("string")
    return rows.select("event_id", dates.date_keyword([none, F.col("raw")], src.AS_OF).alias("day"))


@query(f"""WITH {src.DATES}
SELECT event_id, CASE WHEN kind IN (0, 1, 2, 3) THEN CAST(day AS VARCHAR) WHEN kind = 5 THEN raw
  WHEN kind = 8 THEN '2024-02-' || lpad(CAST(d AS VARCHAR), 2, '0') END AS day FROM dates""")
def date_emotion(spark, sf):
    return src.dates(spark, sf).select("event_id", dates.date_emotion(F.col("raw")).alias("day"))


@query(f"""WITH {src.DATES}
SELECT event_id, CASE WHEN kind IN (2, 6) THEN day
  WHEN kind = 8 AND d <= 29 THEN make_date(2024, 2, d) END AS day FROM dates""")
def date_annotation(spark, sf):
    return src.dates(spark, sf).select("event_id", dates.date_annotation(F.col("raw")).alias("day"))


@query(f"WITH {src.DATES} SELECT event_id, CASE WHEN kind = 3 THEN day END AS day FROM dates")
def date_iso(spark, sf):
    return src.dates(spark, sf).select("event_id", dates.date_iso(F.col("raw")).alias("day"))


@query(f"""WITH {src.DATES}
SELECT event_id, CASE WHEN kind = 2 THEN '2025/' || strftime(day, '%m/%d')
  WHEN kind = 8 AND d <= 28 THEN '2025/02/' || lpad(CAST(d AS VARCHAR), 2, '0')
  WHEN kind = 8 AND d = 29 THEN '2024/02/29' END AS day FROM dates""")
def date_rollback_year(spark, sf):
    next_year = src.AS_OF.replace(year=src.AS_OF.year + 1)
    return src.dates(spark, sf).select(
        "event_id", dates.date_rollback_year(F.col("raw"), next_year).alias("day")
    )


@query(f"""WITH {src.DATES}
SELECT event_id, CASE WHEN kind IN (4, 5) THEN CAST(day AS VARCHAR) ELSE '未知' END AS day,
       CASE kind WHEN 0 THEN raw || ' 00:00:00' WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                 WHEN 5 THEN raw || ':00' ELSE raw END AS clock FROM dates""")
def date_news(spark, sf):
    raw = F.col("raw")
    return src.dates(spark, sf).select(
        "event_id", dates.date_news(raw).alias("day"), dates.date_news_iso(raw).alias("clock")
    )


@query(f"""WITH {src.RAW}, urls AS (SELECT key AS url FROM raw UNION ALL SELECT url FROM pages)
SELECT url, CASE WHEN url ILIKE '%ptt%' THEN 'PTT' WHEN url ILIKE '%dcard%' THEN 'Dcard'
  WHEN url ILIKE '%ettoday%' THEN 'ETtoday' WHEN url ILIKE '%yahoo%' THEN 'Yahoo'
  WHEN url ILIKE '%setn%' THEN '三立新聞網' WHEN url ILIKE '%udn%' THEN '聯合新聞網'
  WHEN url ILIKE '%ltn%' THEN '自由時報' ELSE '其他新聞網' END AS source,
  CASE WHEN url ILIKE '%ptt.cc%' THEN 'PTT' WHEN url ILIKE '%dcard.tw%' THEN 'Dcard'
  WHEN url ILIKE '%ettoday%' THEN 'ETtoday' WHEN url ILIKE '%yahoo%' THEN 'Yahoo'
  WHEN url ILIKE '%setn%' THEN '三立新聞網' WHEN url ILIKE '%udn%' THEN '聯合新聞網'
  WHEN url ILIKE '%ltn%' THEN '自由時報' ELSE '其他新聞網' END AS emotion_source
FROM urls""")
def classify_source(spark, sf):
    raw = src.raw_documents(spark, sf).select(F.col("key").alias("url"))
    urls = raw.unionAll(src.table(spark, sf, "pages").select("url"))
    u = F.col("url")
    return urls.select(
        "url",
        sites.classify_source(u).alias("source"),
        sites.classify_source(u, EMOTION_SOURCES).alias("emotion_source"),
    )


# A by-line in one of four forms in front of every text.
BYLINE = """CASE doc_id % 4
  WHEN 0 THEN '  記者王小明／台北報導 ' WHEN 1 THEN '編譯李大同／綜合 ' WHEN 2 THEN '撰文 陳' || source || '／攝影 '
  ELSE '' END || text"""


@query(f"""WITH d AS (SELECT doc_id, {BYLINE} AS t FROM documents)
SELECT doc_id,
  CASE WHEN doc_id % 4 = 0 THEN '王小明' ELSE '' END AS between_marks,
  CASE WHEN doc_id % 4 = 0 THEN '王小明' ELSE '未知' END AS slash,
  coalesce(nullif(regexp_extract(t, '(記者|編譯)([一-龥]{{2,3}})', 2), ''), '未知') AS editor,
  coalesce(nullif(regexp_extract(t, '記者\\s*([^\\s／]+)', 1), ''),
           nullif(regexp_extract(t, '撰文\\s*([^\\s／]+)', 1), '')) AS byline
FROM d""")
def extract_reporter(spark, sf):
    kind = F.col("doc_id") % 4
    line = (
        F.when(kind == 0, "  記者王小明／台北報導 ")
        .when(kind == 1, "編譯李大同／綜合 ")
        .when(kind == 2, F.concat(F.lit("撰文 陳"), "source", F.lit("／攝影 ")))
        .otherwise("")
    )
    t = F.concat(line, F.col("text"))
    return src.table(spark, sf, "documents").select(
        "doc_id",
        sites.reporter_between(t).alias("between_marks"),
        sites.reporter_slash(t).alias("slash"),
        sites.reporter_or_editor(t).alias("editor"),
        sites.reporter_byline(t).alias("byline"),
    )


STRIP_SET = "' ' || chr(9) || chr(10) || chr(13) || chr(160) || '　'"
PLAIN = """trim(replace(replace(replace(replace(replace(replace(replace(
  regexp_replace({0}, '<[^>]*>', '', 'g'),
  '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), {1})"""

PAGE_SQL = f"""WITH p AS (
  SELECT page_id, url, regexp_replace(html, '<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'gis') AS h
  FROM pages),
a AS (SELECT page_id, url, h, regexp_extract(h, '<article\\b[^>]*>(.*?)</article\\s*>', 1, 'is') AS body FROM p),
s AS (
  SELECT page_id, url, {PLAIN.format("regexp_extract(h, '<h1[^>]*>(.*?)</h1>', 1, 'is')", STRIP_SET)} AS h1,
         {PLAIN.format("regexp_extract(h, '<title[^>]*>(.*?)</title>', 1, 'is')", STRIP_SET)} AS head,
         list_transform(string_split_regex(body, '<[pP](\\s[^>]*)?>')[2:],
           lambda x: {PLAIN.format("regexp_replace(x, '</p>.*$', '', 'is')", STRIP_SET)}) AS paras
  FROM a)
"""


@query(f"""{PAGE_SQL}
SELECT page_id, url, coalesce(nullif(h1, ''), nullif(head, '')) AS title, array_to_string(paras, chr(10)) AS body,
       CAST(NULL AS VARCHAR) AS reporter, CAST(NULL AS VARCHAR) AS date, CAST(NULL AS VARCHAR) AS category FROM s""")
def html_article(spark, sf):
    return art.extract_articles(src.table(spark, sf, "pages"))


@query(f"""{PAGE_SQL}
SELECT page_id, coalesce(nullif(h1, ''), nullif(head, ''), url) AS headline FROM s""")
def fallback_selector(spark, sf):
    # No page has a by-line element, so the first two selectors never find one.
    page = html.visible(F.col("html"))
    picks = [("span", html.css_class("byline")), ("div", html.css_class("headline")), ("h1", ""), ("title", "")]
    headline = text.first_non_empty(html.first_text(page, picks), F.col("url"))
    return src.table(spark, sf, "pages").select("page_id", headline.alias("headline"))


@query("""WITH links AS (
  SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages
  UNION ALL SELECT page_id, url FROM pages)
SELECT page_id, href, CASE WHEN href LIKE 'http%' THEN href ELSE 'https://udn.com' || href END AS link FROM links""")
def url_absolute(spark, sf):
    pages = src.table(spark, sf, "pages")
    hrefs = F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)))
    links = pages.select("page_id", hrefs.alias("href")).unionAll(pages.select("page_id", "url"))
    return links.select("page_id", "href", sites.url_absolute(F.col("href"), "https://udn.com").alias("link"))


@query(f"""WITH {src.RAW}, urls AS (SELECT key AS url FROM raw UNION ALL SELECT url FROM pages)
SELECT url, string_split(url, '/')[-1] AS id FROM urls""")
def article_id(spark, sf):
    raw = src.raw_documents(spark, sf).select(F.col("key").alias("url"))
    urls = raw.unionAll(src.table(spark, sf, "pages").select("url"))
    return urls.select("url", sites.article_id(F.col("url")).alias("id"))


@query(f"""{PAGE_SQL}
SELECT page_id, replace(replace(array_to_string(paras, ''), ' ', ''), chr(10), '') AS body FROM s""")
def squeeze_text(spark, sf):
    article = html.element(html.visible(F.col("html")), "article")
    return src.table(spark, sf, "pages").select(
        "page_id", text.squeeze_text(html.paragraphs(article)).alias("body")
    )


@query("""WITH p AS (
  SELECT page_id, list_filter(string_split(regexp_replace(url, '^https?://', ''), '/'), lambda x: x <> '') AS c FROM pages)
SELECT page_id, CASE WHEN len(c) >= 2 THEN c[-2] || '/' || c[-1] ELSE '未分類' END AS category FROM p""")
def category_path(spark, sf):
    parts = F.filter(F.split(F.regexp_replace("url", "^https?://", ""), "/"), lambda x: x != "")
    return src.table(spark, sf, "pages").select("page_id", sites.category_path(parts).alias("category"))


@query("""SELECT event_id, coalesce(TRY_CAST(regexp_replace(props, '[^0-9]', '', 'g') AS BIGINT), 0) AS k,
  coalesce(TRY_CAST(regexp_replace(event_type, '[^0-9]', '', 'g') AS BIGINT), 0) AS none FROM events""")
def digits_to_int(spark, sf):
    return src.table(spark, sf, "events").select(
        "event_id",
        text.digits_to_int(F.col("props")).alias("k"),
        text.digits_to_int(F.col("event_type")).alias("none"),
    )


@query("""SELECT d.doc_id, coalesce(CAST(quality AS VARCHAR), '') AS quality, coalesce(CAST(toxic AS VARCHAR), '未知') AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def default_strings(spark, sf):
    docs = src.table(spark, sf, "documents").select("doc_id")
    joined = docs.join(src.table(spark, sf, "labels"), "doc_id", "left")
    return joined.select(
        "doc_id",
        text.default_string(F.col("quality")).alias("quality"),
        text.default_string(F.col("toxic"), "未知").alias("toxic"),
    )


@query(f"""WITH {src.POSTS}
SELECT url, pos, tag AS push, "user",
  trim(regexp_replace(regexp_replace(c.content, '\\n+', chr(10), 'g'), '--+', '', 'g'), {STRIP_SET}) AS comment,
  CASE WHEN pos % 4 <> 0 THEN '10.0.' || pos || '.7' END AS ip,
  CASE WHEN pos % 4 = 0 THEN CAST(publish_date AS VARCHAR)
       WHEN pos % 3 = 0 THEN '1/' || pos || ' 12:30'
       ELSE '2024-01-' || lpad(CAST(pos AS VARCHAR), 2, '0') END AS date
FROM comments c JOIN posts USING (url)""")
def comment_time_ip(spark, sf):
    days = src.posts(spark, sf).select("url", "publish_date")
    return stamp_comments(src.comments(spark, sf).join(days, "url"))


@query("SELECT conv_id, turn, text AS body FROM conversations")
def comment_prefix_strip(spark, sf):
    return src.table(spark, sf, "conversations").select(
        "conv_id", "turn", sites.comment_prefix_strip(F.concat(F.lit(": "), "text")).alias("body")
    )


@query("""SELECT event_id, CAST(ts AS DATE) AS publish_date FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-29'""")
def recency_filter(spark, sf):
    events = src.table(spark, sf, "events").select("event_id", F.to_date("ts").alias("publish_date"))
    return art.since(events, dt.date(2024, 1, 30))


@query("""SELECT event_id, CASE WHEN event_type IN ('purchase', 'signup') THEN value ELSE -value END AS score
FROM events""")
def signed_score(spark, sf):
    label = F.when(F.col("event_type").isin("purchase", "signup"), "positive").otherwise("negative")
    return src.table(spark, sf, "events").select("event_id", text.signed_score(label, F.col("value")).alias("score"))


@query("""SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS place, unnest(string_split(text, chr(10))) AS tag FROM documents""")
def hashtags(spark, sf):
    tags = text.hashtags(F.col("text"))
    rows = src.table(spark, sf, "documents").select("doc_id", F.posexplode(tags).alias("place", "tag"))
    return rows.withColumn("place", F.col("place").cast("bigint"))
