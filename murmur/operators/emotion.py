"""Lexicon-based emotions per document and per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmur.functions.fixed import POLARITY
from murmur.operators.joins import literal_table, small_lookup

TOP = 15


def polarity_table(spark: SparkSession, rows: Sequence[tuple[str, int]] = POLARITY) -> DataFrame:
    return literal_table(spark, rows, ["category", "polarity"])


def last_definition(lexicon: DataFrame) -> DataFrame:
    """One category per word: the one defined last (``seq``)."""
    return lexicon.groupBy("word").agg(F.max_by("category", "seq").alias("category"))


def uncovered(lexicon: DataFrame, polarity: DataFrame) -> DataFrame:
    """Categories of the lexicon that have no polarity; a sound pair has none."""
    return last_definition(lexicon).select("category").distinct().join(polarity, "category", "left_anti")


def with_category(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Tokens found in the lexicon, with their category."""
    words = last_definition(lexicon).withColumnRenamed("word", "token")
    return small_lookup(tokens, words, ["token"])


def with_polarity(rows: DataFrame, polarity: DataFrame) -> DataFrame:
    return small_lookup(rows, polarity, ["category"])


def word_counts(tokens: DataFrame, lexicon: DataFrame, doc: Sequence[str]) -> DataFrame:
    """Lexicon words of a document: category, occurrences, first position.

    The tokens of a document lie together, so counting before the shuffle leaves
    about one row per document and word.
    """
    found = with_category(tokens, lexicon)
    return found.groupBy(*doc, F.col("token").alias("word"), "category").agg(
        F.count(F.lit(1)).alias("cnt"), F.min("pos").alias("first_pos")
    )


def category_counts(tokens: DataFrame, lexicon: DataFrame, doc: Sequence[str]) -> DataFrame:
    """Occurrences of each category in a document, and where it came up first."""
    found = with_category(tokens, lexicon)
    return found.groupBy(*doc, "category").agg(
        F.count(F.lit(1)).alias("cnt"), F.min("pos").alias("first_pos")
    )


def doc_emotions(
    docs: DataFrame, tokens: DataFrame, lexicon: DataFrame, polarity: DataFrame, doc: str
) -> DataFrame:
    """``docs`` with their dominant emotion and emotion score.

    The dominant emotion is the most frequent category, of equal ones the one seen
    first, null without matches. The score sums polarities, 0 without matches. A
    document with a category that has no polarity is dropped.
    """
    rated = small_lookup(category_counts(tokens, lexicon, [doc]), polarity, ["category"], "left")
    per_doc = rated.groupBy(doc).agg(
        F.max_by("category", F.struct("cnt", -F.col("first_pos"))).alias("dominant_emotion"),
        F.sum(F.col("cnt") * F.col("polarity")).alias("_score"),
        F.bool_or(F.col("polarity").isNull()).alias("_unrated"),
    )
    joined = docs.join(per_doc, doc, "left").filter("not coalesce(_unrated, false)")
    return joined.withColumn("emotion_score", F.coalesce("_score", F.lit(0))).drop(
        "_score", "_unrated"
    )


def doc_top_words(counts: DataFrame, doc: Sequence[str], k: int = TOP) -> DataFrame:
    """The ``k`` most frequent emotion words of each document, ranked from 1."""
    w = Window.partitionBy(*doc).orderBy(F.desc("cnt"), F.asc("word"))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def daily_emotions(
    tokens: DataFrame,
    lexicon: DataFrame,
    polarity: DataFrame,
    doc: str = "doc_seq",
    k: int = TOP,
) -> DataFrame:
    """For each day, source and rank, the first document that has that rank.

    ``tokens`` carry ``doc``, ``publish_date`` and ``source``; documents compete in
    the order of ``doc``, and the winner brings its word, count, dominant emotion
    and score. Texts are tokenised once: rank, emotion and score come from windows
    over one document each, which share a shuffle. Winners are settled by an
    aggregate, so a hot source is reduced before it is shuffled.
    """
    one = [doc, "publish_date", "source"]
    words = small_lookup(word_counts(tokens, lexicon, one), polarity, ["category"], "left")
    whole = Window.partitionBy(*one)
    kind = Window.partitionBy(*one, "category")
    by_size = Window.partitionBy(*one).orderBy(F.desc("cnt"), F.asc("word"))
    rated = (
        words.withColumn("_n", F.sum("cnt").over(kind))
        .withColumn("_at", F.min("first_pos").over(kind))
        .withColumn(
            "dominant_emotion",
            F.max_by("category", F.struct("_n", -F.col("_at"))).over(whole),
        )
        .withColumn("emotion_score", F.sum(F.col("cnt") * F.col("polarity")).over(whole))
        .withColumn("_unrated", F.bool_or(F.col("polarity").isNull()).over(whole))
        .withColumn("rank", F.row_number().over(by_size))
        .filter((F.col("rank") <= k) & ~F.col("_unrated"))
    )
    taken = F.struct("word", "cnt", "dominant_emotion", "emotion_score")
    return (
        rated.groupBy("publish_date", "source", "rank")
        .agg(F.min_by(taken, doc).alias("_w"))
        .select(
            "publish_date",
            "source",
            "rank",
            F.col("_w.word").alias("emotion_word"),
            "_w.cnt",
            "_w.dominant_emotion",
            "_w.emotion_score",
        )
    )


def daily_emotions_sum(
    tokens: DataFrame, lexicon: DataFrame, polarity: DataFrame, k: int = TOP
) -> DataFrame:
    """Emotion words summed over all documents of a day and source, top ``k``.

    Score and dominant emotion are those of the whole day and source; of equal
    categories the first by name wins.
    """
    group = ["publish_date", "source"]
    found = with_category(tokens, lexicon)
    words = found.groupBy(*group, F.col("token").alias("word"), "category").agg(
        F.count(F.lit(1)).alias("cnt")
    )
    # From here on a group has at most a row per lexicon word, and lies in one place.
    rated = small_lookup(words, polarity, ["category"], "left")
    whole, kind = Window.partitionBy(*group), Window.partitionBy(*group, "category")
    by_size = Window.partitionBy(*group).orderBy(F.desc("cnt"), F.asc("word"))
    sized = F.when(F.col("polarity").isNotNull(), F.struct(-F.col("_n"), F.col("category")))
    ranked = (
        rated.withColumn("_n", F.sum("cnt").over(kind))
        .withColumn("dominant_emotion", F.min_by("category", sized).over(whole))
        .withColumn("emotion_score", F.sum(F.col("cnt") * F.col("polarity")).over(whole))
        .withColumn("rank", F.row_number().over(by_size))
        .filter((F.col("rank") <= k) & F.col("dominant_emotion").isNotNull())
    )
    return ranked.select(
        *group, "rank", F.col("word").alias("emotion_word"), "cnt", "dominant_emotion", "emotion_score"
    )


def sentiment_score(
    docs: DataFrame, tokens: DataFrame, lexicon: DataFrame, polarity: DataFrame, doc: str
) -> DataFrame:
    """Share of positive among polar words of a document, null without any."""
    polar = with_polarity(with_category(tokens, lexicon), polarity)
    per_doc = polar.groupBy(doc).agg(
        F.count_if(F.col("polarity") > 0).alias("_p"), F.count_if(F.col("polarity") < 0).alias("_n")
    )
    score = F.when(F.col("_p") + F.col("_n") > 0, F.col("_p") / (F.col("_p") + F.col("_n")))
    return docs.join(per_doc, doc, "left").withColumn("score", score).drop("_p", "_n")


def emotions_per_document(
    tokens: DataFrame, lexicon: DataFrame, polarity: DataFrame, doc: Sequence[str]
) -> DataFrame:
    """As ``doc_emotions``, in one reading of the texts.

    ``tokens`` have a row without a token for documents without any (``keep_empty``),
    so that these need no second look at the table.
    """
    words = last_definition(lexicon).withColumnRenamed("word", "token")
    found = small_lookup(tokens, words, ["token"], "left").groupBy(*doc, "category").agg(
        F.count(F.lit(1)).alias("cnt"), F.min("pos").alias("first_pos")
    )
    rated = small_lookup(found, polarity, ["category"], "left")
    known = F.col("category").isNotNull()
    per_doc = rated.groupBy(*doc).agg(
        F.max_by("category", F.when(known, F.struct("cnt", -F.col("first_pos")))).alias("dominant_emotion"),
        F.coalesce(F.sum(F.col("cnt") * F.col("polarity")), F.lit(0).cast("bigint")).alias("emotion_score"),
        F.bool_or(known & F.col("polarity").isNull()).alias("_unrated"),
    )
    return per_doc.filter("not _unrated").drop("_unrated")


def sentiment_per_document(
    tokens: DataFrame, lexicon: DataFrame, polarity: DataFrame, doc: Sequence[str]
) -> DataFrame:
    """As ``sentiment_score``, in one reading of the texts; ``tokens`` as above."""
    words = last_definition(lexicon).join(polarity, "category").select(F.col("word").alias("token"), "polarity")
    rated = small_lookup(tokens, words, ["token"], "left")
    counts = rated.groupBy(*doc).agg(
        F.count_if(F.col("polarity") > 0).alias("_p"), F.count_if(F.col("polarity") < 0).alias("_n")
    )
    score = F.when(F.col("_p") + F.col("_n") > 0, F.col("_p") / (F.col("_p") + F.col("_n")))
    return counts.withColumn("score", score).drop("_p", "_n")
