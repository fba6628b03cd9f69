"""Annotation of posts and their comments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.functions.sites import comment_time_ip
from murmur.functions.text import clean_text
from murmur.operators.annotate import Annotator, annotate
from murmur.operators.joins import salted_lookup
from murmur.operators.tables import unprocessed


def annotate_threads(
    posts: DataFrame,
    comments: DataFrame,
    done: DataFrame,
    factory: Callable[[], Annotator],
) -> DataFrame:
    """Annotations of new posts (``url``) and of their comments (``url``, ``pos``).

    Both go through the model in one pass, so it is loaded once per task and long
    threads spread like posts. Rows come back with ``kind`` ``post`` or
    ``comment``; write them partitioned by it, so the model runs once.
    """
    todo = unprocessed(posts, done)
    of_todo = salted_lookup(comments, todo.select("url"), ["url"], "left_semi")
    post_id = F.concat(F.lit("p "), "url")
    comment_id = F.concat(F.lit("c "), F.col("pos").cast("string"), F.lit(" "), "url")
    texts = todo.select(post_id.alias("id"), "content").unionByName(
        of_todo.select(comment_id.alias("id"), "content")
    )
    out = annotate(texts, factory, url="id")
    mark = r"^(?:p|c ([0-9]+)) (.*)$"
    number = F.regexp_extract("url", mark, 1)
    return out.select(
        F.when(number == "", "post").otherwise("comment").alias("kind"),
        F.regexp_extract("url", mark, 2).alias("url"),
        number.try_cast("bigint").alias("pos"),
        "words",
        F.col("pos").alias("tags"),
        "entities",
    )


def stamp_comments(comments: DataFrame, year: int = 2024, day: str | None = "publish_date") -> DataFrame:
    """Comments with cleaned body, IP and date; empty ones are dropped.

    ``day`` names the column to fall back on for the date, none for null.
    """
    default = F.col(day) if day else F.lit(None)
    stamp = comment_time_ip(F.col("time"), default, year)
    return comments.withColumn("_stamp", stamp).select(
        "url",
        "pos",
        F.col("tag").alias("push"),
        "user",
        clean_text(F.col("content")).alias("comment"),
        "_stamp.ip",
        "_stamp.date",
    ).filter("comment != ''")
