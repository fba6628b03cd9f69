"""Comment threads: flattening, nesting, merging, counting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.functions.fixed import BOO_TAG, PUSH_TAG
from murmur.functions.text import clean_text
from murmur.operators.joins import salted_lookup

# Comments per nested document. A thread of any length stays whole: it takes as
# many documents as it needs, and no task holds more than one of them.
CHUNK = 10_000

BODY = ("tag", "user", "content", "time")


def explode_comments(
    posts: DataFrame,
    column: str,
    fields: Sequence[str] = ("推文", "用戶", "內容", "時間"),
    url: str = "url",
) -> DataFrame:
    """One row per struct of the comment array, with its position."""
    tag, user, content, time = (F.col(f"_c.`{f}`") for f in fields)
    return posts.select(F.col(url).alias("url"), F.posexplode(column).alias("pos", "_c")).select(
        "url",
        F.col("pos").cast("bigint").alias("pos"),
        F.lit(None).cast("string").alias("comment_id"),
        tag.alias("tag"),
        user.alias("user"),
        content.alias("content"),
        time.alias("time"),
    )


def explode_comment_maps(
    posts: DataFrame,
    column: str,
    fields: Sequence[str] = ("用戶", "內容", "時間"),
    url: str = "url",
    day: str = "publish_date",
) -> DataFrame:
    """One row per entry of an array of ``{floor: comment}`` maps.

    Bodies are cleaned and empty ones dropped; a comment without a time takes the
    day of its article.
    """
    user, content, time = (F.col(f"_c.`{f}`") for f in fields)
    floors = posts.select(
        F.col(url).alias("url"),
        F.col(day).cast("string").alias("_day"),
        F.posexplode(column).alias("pos", "_m"),
    ).select("url", "_day", "pos", F.explode("_m").alias("comment_id", "_c"))
    return floors.select(
        "url",
        F.col("pos").cast("bigint").alias("pos"),
        "comment_id",
        F.lit(None).cast("string").alias("tag"),
        user.alias("user"),
        clean_text(content).alias("content"),
        F.coalesce(time, F.col("_day")).alias("time"),
    ).filter("content != ''")


def nest_comments(
    comments: DataFrame, articles: DataFrame, keep_empty: bool, chunk: int = CHUNK
) -> DataFrame:
    """Article rows with their comments as one array, in order of position.

    A document is keyed by (url, ``chunk_no``), for short threads and long ones alike:
    every ``chunk`` positions begin the next one, and ``chunks`` is how many the
    thread has. ``keep_empty`` keeps articles without comments, with an empty array.
    """
    number = F.floor(F.col("pos") / chunk).cast("bigint")
    body = [c for c in comments.columns if c not in ("url", "pos")]
    nested = (
        comments.groupBy("url", number.alias("chunk_no"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", *body))).alias("comments"))
    )
    # An article is repeated once per document of its thread, so the join runs on
    # (url, chunk_no) and a hot thread is spread like any other data.
    last = comments.groupBy("url").agg(F.max(number).alias("_last"))
    how = "left" if keep_empty else "inner"
    spread = articles.join(last, "url", how).withColumn(
        "chunk_no", F.explode(F.sequence(F.lit(0), F.coalesce("_last", F.lit(0)).cast("bigint")))
    )
    joined = spread.join(nested, ["url", "chunk_no"], how)
    if keep_empty:
        empty = F.array().cast(nested.schema["comments"].dataType)
        joined = joined.filter("comments is not null or _last is null").withColumn(
            "comments", F.coalesce("comments", empty)
        )
    return joined.withColumn("chunks", F.coalesce("_last", F.lit(0)).cast("bigint") + 1).drop("_last")


def new_comments(old: DataFrame, new: DataFrame, body: Sequence[str] = BODY) -> DataFrame:
    """Comments of ``new`` that ``old`` lacks; equal ones within ``new`` all stay.

    Joined on the whole comment, so a long thread spreads over many tasks. Missing
    fields compare as equal. Both sides come straight from their shuffle, so
    adaptive execution can split copies of one comment that fill a partition.
    """
    same = F.col("n.url") == F.col("o.url")
    for c in body:
        same = same & F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
    return new.alias("n").join(old.select("url", *body).alias("o"), same, "left_anti")


def merge_comments(old: DataFrame, new: DataFrame, body: Sequence[str] = BODY) -> DataFrame:
    """``old`` followed by what is new, thread by thread.

    New comments are numbered from the end of the old thread on, one after the other
    in their order, so a thread grows by what is new however often it is crawled.
    """
    ends = old.groupBy("url").agg((F.max("pos") + 1).alias("_end"))
    in_order = Window.partitionBy("url").orderBy("pos", *body)
    added = new_comments(old, new, body).withColumn("pos", F.row_number().over(in_order) - 1)
    added = salted_lookup(added, ends, ["url"])
    added = added.withColumn("pos", (F.coalesce("_end", F.lit(0)) + F.col("pos")).cast("bigint")).drop("_end")
    return old.unionByName(added.select(*old.columns))


def push_counts(comments: DataFrame, posts: DataFrame | None = None) -> DataFrame:
    """Pushes, boos and arrows per post, up to the first comment without a tag.

    Every post counts, with zeros where nothing comes before that comment; ``posts``
    (``url``) adds those without any comment.
    """
    bad = comments.filter("tag is null").groupBy("url").agg(F.min("pos").alias("_bad"))
    read = F.col("_bad").isNull() | (F.col("pos") < F.col("_bad"))
    counts = salted_lookup(comments, bad, ["url"]).groupBy("url").agg(
        F.count_if(read & (F.col("tag") == PUSH_TAG)).alias("push"),
        F.count_if(read & (F.col("tag") == BOO_TAG)).alias("boo"),
        F.count_if(read & ~F.col("tag").isin(PUSH_TAG, BOO_TAG)).alias("arrow"),
    )
    if posts is None:
        return counts
    return posts.select("url").distinct().join(counts, "url", "left").na.fill(0, ["push", "boo", "arrow"])


def thread_envelope(articles: DataFrame, source: str) -> DataFrame:
    """Nested articles as (url, chunk_no, data) documents; url and chunk_no are their key."""
    rest = [c for c in articles.columns if c not in ("url", "chunk_no")]
    return articles.select("url", "chunk_no", F.struct(F.lit(source).alias("source"), *rest).alias("data"))


def emoji_map(popup: Column) -> Column:
    """Text of alternating lines ``name`` and ``count`` as a map of names to counts as text."""
    lines = F.split(popup, "\n")
    names = F.filter(lines, lambda x, i: i % 2 == 0)
    counts = F.filter(lines, lambda x, i: i % 2 == 1)
    pairs = F.filter(F.arrays_zip(names.alias("name"), counts.alias("n")), lambda p: p["n"].isNotNull())
    # of a name given twice the last count holds, as in a dictionary
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["name"] == p["name"]))
    return F.when(popup.isNotNull(), F.map_from_entries(last))


def emoji_total(shown: Column) -> Column:
    """The total as a number; text that is none counts 0."""
    return F.coalesce(shown.try_cast("bigint"), F.lit(0).cast("bigint"))


def emoji_counts(posts: DataFrame, column: str = "emoji_type", url: str = "url") -> DataFrame:
    """Array of emoji -> count maps to rows; counts that are no number are null."""
    maps = posts.select(F.col(url).alias("url"), F.explode(column).alias("_m"))
    return maps.select("url", F.explode("_m").alias("emoji", "_n")).select(
        "url", "emoji", F.col("_n").try_cast("bigint").alias("n")
    )
