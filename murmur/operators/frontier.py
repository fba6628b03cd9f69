"""Crawl frontier: a state table folded from an event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.functions.sites import article_id
from murmur.operators.joins import salted_lookup
from murmur.operators.tables import absent
from murmur.schema import FRONTIER

FAILED = "failed"


def seed(frontier: DataFrame, found: DataFrame, order: str = "seq") -> DataFrame:
    """Add discovered URLs (``url``, ``date``, ``order``) that are not known yet."""
    new = absent(frontier, found.select("url", "date", order), ["url"], [order])
    rows = new.select(
        article_id(F.col("url")).alias("id"),
        "date",
        "url",
        F.lit(0).alias("first_crawl"),
        F.lit(0).cast("bigint").alias("confirm_num"),
        F.lit(None).cast("date").alias("last_update"),
    )
    return frontier.unionByName(rows)


def pending(frontier: DataFrame) -> DataFrame:
    """URLs not crawled yet."""
    return frontier.filter("first_crawl = 0")


def recheck(frontier: DataFrame) -> DataFrame:
    """URLs in rotation, least checked first."""
    return frontier.filter("confirm_num > 0").orderBy("confirm_num", "url")


def fold(events: DataFrame) -> DataFrame:
    """Events (``url``, ``seq``, ``kind``, ``date``) folded to one row per URL.

    A failure ends the life of a URL, so its date is that of the first failure. The
    buffers are plain numbers and dates: a hash aggregate, in a stream as well.
    """
    failed = F.col("kind") == FAILED
    return events.groupBy("url").agg(
        F.min(F.when(failed, F.col("seq"))).alias("failed_seq"),
        F.count_if(~failed).alias("ok"),
        F.min_by("date", F.when(failed, F.col("seq"))).alias("failed_on"),
        F.max_by("date", "seq").alias("last_on"),
        F.max("seq").alias("last_seq"),
    )


def merge_folds(folded: DataFrame) -> DataFrame:
    """Folds of several sets of events as the fold of all of them."""
    return folded.groupBy("url").agg(
        F.min_by("failed_on", "failed_seq").alias("failed_on"),
        F.sum("ok").alias("ok"),
        F.max_by("last_on", "last_seq").alias("last_on"),
        F.min("failed_seq").alias("failed_seq"),
        F.max("last_seq").alias("last_seq"),
    )


def settle(folded: DataFrame) -> DataFrame:
    """State of each URL after its events."""
    failed = F.col("failed_seq").isNotNull()
    return folded.select(
        "url",
        F.lit(1).alias("first_crawl"),
        F.when(failed, F.lit(0)).otherwise(F.col("ok")).cast("bigint").alias("confirm_num"),
        F.when(failed, F.col("failed_on")).otherwise(F.col("last_on")).alias("last_update"),
    )


def apply_events(frontier: DataFrame, events: DataFrame) -> DataFrame:
    """The frontier after a batch of events.

    URLs out of rotation stay as they are, events of unknown URLs change nothing.
    """
    return apply_folds(frontier, fold(events))


def apply_folds(frontier: DataFrame, folded: DataFrame) -> DataFrame:
    """As ``apply_events``, for events that are folded already."""
    new = settle(folded).select(
        "url", F.struct("first_crawl", "confirm_num", "last_update").alias("_new")
    )
    joined = frontier.join(new, "url", "left")
    ended = (F.col("first_crawl") == 1) & (F.col("confirm_num") == 0)
    keep = F.col("_new").isNull() | ended
    failed = F.col("_new.confirm_num") == 0
    return joined.select(
        "id",
        "date",
        "url",
        F.when(keep, F.col("first_crawl")).otherwise(1).alias("first_crawl"),
        F.when(keep, F.col("confirm_num"))
        .when(failed, F.lit(0).cast("bigint"))
        .otherwise(F.col("confirm_num") + F.col("_new.confirm_num"))
        .alias("confirm_num"),
        F.when(keep, F.col("last_update")).otherwise(F.col("_new.last_update")).alias("last_update"),
    )


def late_events(events: DataFrame) -> DataFrame:
    """Events after the failure of their URL, set aside for inspection."""
    failures = (
        events.filter(F.col("kind") == FAILED).groupBy("url").agg(F.min("seq").alias("_failed"))
    )
    return salted_lookup(events, failures, ["url"], "inner").filter("seq > _failed").drop("_failed")


def empty_frontier(like: DataFrame) -> DataFrame:
    """A frontier without URLs, in the session of ``like``."""
    return like.sparkSession.createDataFrame([], FRONTIER)
