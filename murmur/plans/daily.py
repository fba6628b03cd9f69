"""The two report jobs: daily keywords and daily emotions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.functions.dates import text_day
from murmur.operators import emotion, keywords
from murmur.operators.articles import (
    normalize_for_emotions,
    normalize_for_keywords,
    reject_incomplete,
)
from murmur.operators.layout import spread
from murmur.operators.tokens import tokenize_with


# A lexicon for Han text: a table with a column ``word``, or the words, in any number.
Words = DataFrame | Sequence[str] | None


def keyword_tokens(docs: DataFrame, as_of: dt.date, words: Words = None, lower: bool = True) -> DataFrame:
    """(doc_seq, key, value) documents to dated tokens for keyword counts."""
    articles = reject_incomplete(normalize_for_keywords(spread(docs, "doc_seq"), as_of))
    dated = articles.withColumn("publish_date", text_day(F.col("publish_day")))
    dated = reject_incomplete(dated, ("publish_day",)).filter("publish_date is not null")
    return tokenize_with(dated, "doc_seq", keywords.GROUP, words, lower)


def daily_keywords(
    docs: DataFrame,
    stopwords: DataFrame,
    as_of: dt.date,
    words: Words = None,
    k: int = keywords.TOP,
    min_len: int = 1,
    tie: str = "keyword",
    lower: bool = True,
) -> DataFrame:
    """Top keywords per day and source; without ``lower`` words keep their case."""
    seen = ("doc_seq", "pos") if tie == "first_seen" else ()
    counts = keywords.keyword_counts(keyword_tokens(docs, as_of, words, lower), first_seen=seen)
    return keywords.top_keywords(keywords.valid_keywords(counts, stopwords, min_len), k, tie=tie)


def emotion_articles(docs: DataFrame, year: int = 2024) -> DataFrame:
    """(doc_seq, key, value) documents to dated articles for emotions."""
    articles = reject_incomplete(
        normalize_for_emotions(spread(docs, "doc_seq"), year), ("content", "raw_date", "url")
    )
    return articles.withColumn("publish_date", text_day(F.col("publish_day"))).filter(
        "publish_date is not null"
    )


def emotion_tokens(articles: DataFrame, words: Words = None) -> DataFrame:
    return tokenize_with(articles, "doc_seq", ["publish_date", "source"], words)


def daily_emotions(
    docs: DataFrame,
    lexicon: DataFrame,
    polarity: DataFrame,
    words: Words = None,
    year: int = 2024,
    mode: str = "first",
    k: int = emotion.TOP,
) -> DataFrame:
    """Emotion words per day, source and rank.

    ``mode`` is ``first`` for the first document that has a rank, or ``sum`` for
    counts over all documents.
    """
    found = emotion_tokens(emotion_articles(docs, year), words)
    if mode == "sum":
        return emotion.daily_emotions_sum(found, lexicon, polarity, k)
    return emotion.daily_emotions(found, lexicon, polarity, k=k)
