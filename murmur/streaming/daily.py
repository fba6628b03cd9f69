"""Running daily keyword counts and frontier states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from murmur.operators.frontier import apply_folds, fold, merge_folds, settle
from murmur.operators.keywords import GROUP, keyword_counts, top_keywords, valid_keywords
from murmur.operators.tokens import tokenize
from murmur.streaming.log import BASE, put, start


def daily_keywords_stream(
    articles: DataFrame, table: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Count words per day and source over a stream of articles.

    Counts add up, so the stream keeps no state: each batch writes its own counts, and
    readers sum them. A batch that runs again replaces what it wrote. A late post
    still counts, as it does in the batch job.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        put(keyword_counts(tokenize(batch, GROUP)), table, batch_id)

    return start(articles, write, checkpoint, trigger=trigger)


def running_counts(spark: SparkSession, table: str) -> DataFrame:
    """Counts per day, source and word over all batches."""
    return spark.read.parquet(table).groupBy(*GROUP, "keyword").agg(F.sum("cnt").alias("cnt"))


def read_daily_keywords(spark: SparkSession, table: str, stopwords: DataFrame, k: int = 15) -> DataFrame:
    """Top keywords from the counts of all batches."""
    return top_keywords(valid_keywords(running_counts(spark, table), stopwords), k)


def compact_counts(spark: SparkSession, table: str, into: str) -> None:
    """Sum the counts of all batches into the base of a new log."""
    put(running_counts(spark, table), into, BASE)


def frontier_stream(
    events: DataFrame, table: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Fold crawl events per URL, batch by batch; folds merge, so no state is kept."""
    return start(events, lambda b, i: put(fold(b), table, i), checkpoint, trigger=trigger)


def read_frontier(spark: SparkSession, table: str, frontier: DataFrame | None = None) -> DataFrame:
    """State of each URL after all batches; with ``frontier`` this table after them."""
    folded = merge_folds(spark.read.parquet(table))
    return settle(folded) if frontier is None else apply_folds(frontier, folded)
