"""Documents of two vocabularies to canonical articles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions import dates, sites
from murmur.functions.fixed import EMOTION_SOURCES
from murmur.functions.html import GENERIC, PageRules, read_article
from murmur.functions.text import clean_text, first_non_empty
from murmur.operators.layout import spread
from murmur.schema import ARTICLE_FIELDS


def _fields(docs: DataFrame) -> dict[str, Column]:
    """Each known article field of ``value``, null where the data lacks it."""
    present = set(docs.schema["value"].dataType.names)
    return {
        name: F.col(f"value.`{name}`") if name in present else F.lit(None).cast("string")
        for name in ARTICLE_FIELDS
    }


def _shared(v: dict[str, Column]) -> list[Column]:
    return [
        F.col("key").alias("url"),
        first_non_empty(v["標題"], v["title"]).alias("title"),
        first_non_empty(v["作者"], v["author"], v["reporter"]).alias("author"),
    ]


def _carried(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in ("key", "value")]


def normalize_for_keywords(docs: DataFrame, as_of: dt.date) -> DataFrame:
    """(key, value) documents to articles the way the keyword job reads them."""
    v = _fields(docs)
    days = [v[n] for n in ("發佈日期", "date", "發布時間", "publish_date")]
    return docs.select(
        *_carried(docs),
        *_shared(v),
        first_non_empty(v["內容"], v["content"]).alias("content"),
        dates.date_keyword(days, as_of).alias("publish_day"),
        # This job reads a null key as a text like any other, which names no site.
        sites.classify_source(F.coalesce("key", F.lit("None"))).alias("source"),
    )


def normalize_for_emotions(docs: DataFrame, year: int = 2024) -> DataFrame:
    """(key, value) documents to articles the way the emotion job reads them.

    The link decides which vocabulary holds the content and the day.
    """
    v = _fields(docs)
    ptt, dcard = F.col("key").contains("ptt.cc"), F.col("key").contains("dcard.tw")
    content = F.when(ptt | dcard, v["內容"]).otherwise(v["content"])
    raw = F.when(ptt, v["發佈日期"]).when(dcard, v["發布時間"]).otherwise(v["date"])
    return docs.select(
        *_carried(docs),
        *_shared(v),
        content.alias("content"),
        raw.alias("raw_date"),
        dates.date_emotion(raw, year).alias("publish_day"),
        sites.classify_source(F.col("key"), EMOTION_SOURCES).alias("source"),
    )


def normalize_for_annotation(docs: DataFrame, full_dates_only: bool = False) -> DataFrame:
    """(key, value) documents to cleaned articles for the annotators."""
    v = _fields(docs)
    raw = first_non_empty(v["date"], v["發布時間"], v["發佈日期"])
    day = F.coalesce(dates.date_iso(raw), dates.date_annotation(raw, full_only=full_dates_only))
    return docs.select(
        *_carried(docs),
        *_shared(v),
        clean_text(first_non_empty(v["post"], v["內容"], v["content"])).alias("content"),
        day.alias("publish_date"),
    )


def reject_incomplete(articles: DataFrame, required: tuple[str, ...] = ("content",)) -> DataFrame:
    """Articles whose required fields are neither null nor empty."""
    for c in required:
        articles = articles.filter(F.col(c).isNotNull() & (F.col(c) != ""))
    return articles


def since(articles: DataFrame, as_of: dt.date, days: int = 1, column: str = "publish_date") -> DataFrame:
    """Articles no older than ``days`` before ``as_of``; prunes date partitions."""
    return articles.filter(F.col(column) >= F.lit(as_of - dt.timedelta(days=days)))


def extract_articles(pages: DataFrame, rules: PageRules = GENERIC) -> DataFrame:
    """Raw HTML pages to article fields."""
    fields = read_article(F.col("html"), rules)
    pages = spread(pages.select("page_id", "url", "html"), "page_id")
    return pages.select("page_id", "url", *(c.alias(n) for n, c in fields.items()))
