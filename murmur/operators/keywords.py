"""Daily keywords per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.functions.text import is_valid_keyword, strip
from murmur.operators.joins import small_lookup

TOP = 15
GROUP = ("publish_date", "source")


def union_stopwords(*parts: DataFrame) -> DataFrame:
    """All words of several one-column tables, once each."""
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


def drop_stopwords(rows: DataFrame, stopwords: DataFrame, column: str) -> DataFrame:
    """Rows whose stripped word is no stopword; the word itself stays as it is."""
    return _without(rows, stopwords, strip(F.col(column)))


def _without(rows: DataFrame, stopwords: DataFrame, word: Column) -> DataFrame:
    stop = stopwords.select(F.col("word").alias("_stop")).distinct()
    return small_lookup(rows.withColumn("_stop", word), stop, ["_stop"], "left_anti").drop("_stop")


def keyword_counts(
    tokens: DataFrame, group: Sequence[str] = GROUP, first_seen: Sequence[str] = ()
) -> DataFrame:
    """Occurrences per group and word.

    Counting comes before the tests on words: tasks reduce their tokens to the
    vocabulary first, so the tests run once per word and a hot group reaches the
    shuffle spread over its words. ``first_seen`` (document and position columns)
    adds the place where a word came up first.
    """
    aggs = [F.count(F.lit(1)).alias("cnt")]
    if first_seen:
        doc, pos = first_seen
        # One number orders by document, then position, and unlike a struct it can
        # be updated in place by the hash aggregate.
        place = F.col(doc).cast("decimal(38,0)") * F.lit(2**31).cast("decimal(10,0)") + F.col(pos)
        aggs.append(F.min(place.cast("decimal(38,0)")).alias("first_seen"))
    return tokens.groupBy(*group, F.col("token").alias("keyword")).agg(*aggs)


def valid_keywords(counts: DataFrame, stopwords: DataFrame, min_len: int = 1) -> DataFrame:
    """Counted words that may be reported.

    Both tests look at the count as well, which keeps Catalyst from moving them
    below the aggregate, where they would run once per token.
    """
    counted = F.col("cnt") > 0
    valid = counts.filter(F.when(counted, is_valid_keyword(F.col("keyword"), min_len)))
    return _without(valid, stopwords, F.when(counted, strip(F.col("keyword"))))


def top_keywords(
    counts: DataFrame,
    k: int = TOP,
    group: Sequence[str] = GROUP,
    tie: str = "keyword",
) -> DataFrame:
    """The ``k`` most frequent words of each group, ranked from 1.

    ``tie`` orders words of the same count: ``keyword``, or ``first_seen`` for the
    order in which they came up. Each task keeps ``k`` rows per group before the
    shuffle, whatever the size of the group.
    """
    w = Window.partitionBy(*group).orderBy(F.desc("cnt"), F.asc(tie))
    ranked = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select(*group, "rank", "keyword", "cnt")


def top_keywords_padded(
    counts: DataFrame, date: object, source: str, n: int = TOP
) -> DataFrame:
    """Ranks 1..n of one day and source, null where there are fewer words."""
    one = counts.filter((F.col("publish_date") == F.lit(date)) & (F.col("source") == source))
    ranked = top_keywords(one, n).select("rank", "keyword", "cnt")
    ranks = counts.sparkSession.range(1, n + 1).select(F.col("id").cast("int").alias("rank"))
    return ranks.join(ranked, "rank", "left")
