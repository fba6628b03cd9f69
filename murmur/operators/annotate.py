"""Words, parts of speech and entities of documents."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.functions.counts import with_counts
from murmur.functions.text import clean_text, tokens
from murmur.operators.joins import small_lookup
from murmur.operators.layout import by_document, partitions
from murmur.schema import ANNOTATION

# What a model does: texts in, one (words, tags, [(entity, type)]) per text out.
Annotator = Callable[[list[str]], list[tuple[list[str], list[str], list[tuple[str, str]]]]]

# The model that this worker process has built last.
MODELS: dict[str, Annotator] = {}

# Texts that a model gets at once, in characters; one text may be longer.
CHARS_AT_ONCE = 1 << 19


def slices(texts: Sequence[str], limit: int = CHARS_AT_ONCE) -> Iterator[slice]:
    """Stretches of texts with at most ``limit`` characters in all, one text at least."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield slice(start, i)
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def annotate(
    docs: DataFrame, factory: Callable[[], Annotator], url: str = "url", content: str = "content"
) -> DataFrame:
    """Run a model over all texts, batch by batch.

    Words, tags and names take many times the memory of their texts, so a batch, which is bounded by its rows
    alone, goes through the model in stretches of ``CHARS_AT_ONCE`` characters. ``factory`` builds the model, once per worker process rather than per task. Only
    the two columns needed are sent to Python, and empty texts are dropped before.
    """
    name = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The pickled function is new in every task; the module's attributes are not.
        import murmur.operators.annotate as here

        if name not in here.MODELS:
            here.MODELS.clear()
            here.MODELS[name] = factory()
        model = here.MODELS[name]
        for batch in batches:
            for part in here.slices(batch["content"].tolist()):
                out = model(batch["content"].iloc[part].tolist())
                yield pd.DataFrame(
                    {
                        "url": batch["url"].iloc[part].reset_index(drop=True),
                        "words": [o[0] for o in out],
                        "pos": [o[1] for o in out],
                        "entities": [[{"entity": e, "type": t} for e, t in o[2]] for o in out],
                    }
                )

    texts = docs.select(F.col(url).alias("url"), clean_text(F.col(content)).alias("content"))
    return texts.filter("content != ''").mapInPandas(run, ANNOTATION)


def annotate_words(
    docs: DataFrame,
    carry: Sequence[str],
    content: str = "content",
    words: Sequence[str] = (),
    lower: bool = False,
) -> DataFrame:
    """Default annotator without a model: tokens, tagged by script.

    Tags are ``Neu`` for numbers, ``FW`` for words of other scripts than Han and
    ``Na`` for the rest.
    """
    found = tokens(F.col(content), words, lower)
    tag = lambda w: (
        F.when(w.rlike(r"^\p{N}+$"), F.lit("Neu"))
        .when(w.rlike("[一-鿿]"), F.lit("Na"))
        .otherwise(F.lit("FW"))
    )
    return docs.select(*carry, found.alias("words")).withColumn("pos", F.transform("words", tag))


def gazetteer_entities(docs: DataFrame, gazetteer: DataFrame, carry: Sequence[str], words: str = "words") -> DataFrame:
    """Names of the gazetteer (``word``, ``type``) in ``words``, one row per mention and type.

    A name is one or more words, split at white space. Of overlapping names the one
    that begins first holds, and of those that begin together the longest, from left
    to right; ``pos`` is the place of its first word. ``carry`` identifies a document.

    The names form a trie of two levels, so a gazetteer may have any size: the first two
    words lead to the lengths of the names that go on from there, and each length to a
    whole name. Both are lookups by key. Rows hold as many words as the longest name, so
    nothing is shuffled before a match while the names fit a broadcast.
    """
    names = (
        gazetteer.select(F.filter(F.split("word", r"\s+"), lambda w: w != "").alias("_name"), "type")
        .filter("size(_name) > 0")
        .groupBy("_name")
        .agg(F.sort_array(F.collect_set("type")).alias("_types"))
        .withColumn("_n", F.size("_name"))
    )
    longest = names.agg(F.max("_n")).first()[0] or 1
    rows = docs.select(*carry, words, F.posexplode(words).alias("pos", "token")).filter("token is not null").select(
        *carry, "pos", "token", F.slice(words, F.col("pos") + 1, longest).alias("_ahead")
    )
    single = names.filter("_n = 1").select(F.col("_name")[0].alias("token"), "_types")
    found = small_lookup(rows, single, ["token"]).select(*carry, "pos", F.array("token").alias("_name"), "_types")
    if longest > 1:
        several = names.filter("_n > 1")
        heads = several.groupBy(F.col("_name")[0].alias("token"), F.col("_name")[1].alias("_second")).agg(
            F.collect_set("_n").alias("_lengths")
        )
        begun = small_lookup(rows.withColumn("_second", F.get("_ahead", F.lit(1))), heads, ["token", "_second"])
        tried = begun.select(*carry, "pos", "_ahead", F.explode("_lengths").alias("_n")).filter("size(_ahead) >= _n")
        whole = tried.select(*carry, "pos", F.slice("_ahead", F.lit(1), F.col("_n")).alias("_name"))
        found = found.unionByName(small_lookup(whole, several.drop("_n"), ["_name"]).select(*carry, "pos", "_name", "_types"))
    kept = found if longest == 1 else leftmost_longest(found.withColumn("_n", F.size("_name")), carry)
    return kept.select(*carry, "pos", F.array_join("_name", " ").alias("entity"), F.explode("_types").alias("type"))


def leftmost_longest(found: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Of matches (``pos``, ``_n`` words) in a document those that hold from left to right.

    Matches that begin where all earlier ones have ended start a new run, and only
    within a run the choice is one after the other; runs are short, whatever the document.
    """
    end = F.col("pos") + F.col("_n")
    order = Window.partitionBy(*carry).orderBy("pos", F.desc("_n"))
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(before.isNull() | (F.col("pos") >= before), 1).otherwise(0)
    runs = found.withColumn("_starts", starts).withColumn("_run", F.sum("_starts").over(order))
    fields = [c for c in found.columns if c not in carry]
    items = F.sort_array(F.collect_list(F.struct("pos", (-F.col("_n")).alias("_order"), F.struct(*fields).alias("_m"))))
    grouped = runs.groupBy(*carry, "_run").agg(items.alias("_items"))
    none = F.struct(F.lit(0).alias("end"), F.slice(F.transform("_items", lambda x: x["_m"]), 1, 0).alias("kept"))
    take = lambda acc, x: F.when(
        x["pos"] >= acc["end"],
        F.struct((x["pos"] - x["_order"]).alias("end"), F.concat(acc["kept"], F.array(x["_m"])).alias("kept")),
    ).otherwise(acc)
    return grouped.select(*carry, F.explode(F.aggregate("_items", none, take)["kept"]).alias("_m")).select(*carry, "_m.*")


def word_pos_frequency(annotated: DataFrame, doc: str = "url") -> DataFrame:
    """One row per token: word, tag and how often the word occurs in the document."""
    pairs = by_document(annotated.select(doc, "words", "pos"), doc).select(
        doc, F.posexplode_outer(F.arrays_zip("words", "pos")).alias("pos_idx", "_t")
    )
    rows = pairs.filter("pos_idx is not null").select(
        doc, "pos_idx", F.col("_t.words").alias("word"), F.col("_t.pos").alias("pos")
    )
    w = Window.partitionBy(doc, "word")
    return rows.withColumn("frequency", F.count(F.lit(1)).over(w))


def entity_mentions(
    annotated: DataFrame, doc: str = "url", day: str = "publish_date"
) -> DataFrame:
    """One row per mention; ``counts`` counts the entity text whatever its type."""
    rows = by_document(annotated.select(doc, day, "entities"), doc).select(
        doc, F.col(day).alias("publish_date"), F.posexplode_outer("entities").alias("idx", "_e")
    )
    rows = rows.filter("idx is not null")
    w = Window.partitionBy(doc, "entity")
    return rows.select(doc, "idx", "_e.entity", "_e.type", "publish_date").select(
        doc, "idx", "entity", "type", F.count(F.lit(1)).over(w).alias("counts"), "publish_date"
    )


def pos_filter(annotated: DataFrame, stop_pos: Sequence[str]) -> DataFrame:
    """Drop words with unwanted tags, and their tags."""
    pairs = F.filter(
        F.arrays_zip("words", "pos"), lambda p: ~p["pos"].isin(*stop_pos) | p["pos"].isNull()
    )
    kept = annotated.withColumn("_pairs", pairs)
    return kept.withColumn("words", F.col("_pairs.words")).withColumn("pos", F.col("_pairs.pos")).drop("_pairs")


def annotated_content(articles: DataFrame, annotated: DataFrame | None, source: str) -> DataFrame:
    """Annotated articles as (url, data) documents; ``url`` is the key on both sides.

    Without ``annotated`` the articles hold ``words``, ``pos`` and ``entities`` themselves.
    Documents move once, by ``url``; words and entities are counted in the arrays that hold them, so none becomes a
    row. Rows that share a url are one document. Articles without words are left out.
    """
    fields = ["url", "publish_date", "title", "author", "content"]
    found = ["words", "pos", "entities"]
    if annotated is None:
        docs = by_document(articles.select(*fields, *found), "url")
    else:
        n = max(partitions(articles), partitions(annotated))
        docs = articles.select(*fields).repartition(n, "url").join(
            annotated.select("url", *found).repartition(n, "url"), "url"
        )
    # Rows without words are passed over here: a filter would be moved below and find the words twice.
    has = F.size("words") > 0
    whole = docs.groupBy("url").agg(
        F.first(F.when(has, F.struct(*fields[1:])), ignorenulls=True).alias("_a"),
        F.collect_list(F.when(has, F.struct(*found))).alias("_rows"),
    ).filter("_a is not null")
    word = lambda x: F.struct(x["words"].alias("name"), x["pos"].alias("tag"))
    entity = lambda x: F.struct(x["entity"].alias("name"), x["type"].alias("tag"))
    none = F.array().cast("array<struct<name: string, tag: string>>")
    words = F.flatten(F.transform("_rows", lambda r: F.transform(F.arrays_zip(r["words"].alias("words"), r["pos"].alias("pos")), word)))
    entities = F.flatten(F.transform("_rows", lambda r: F.coalesce(F.transform(r["entities"], entity), none)))
    day = F.col("_a.publish_date")
    word_of = lambda x: F.struct(x["name"].alias("word"), x["tag"].alias("pos"), x["n"].alias("frequency"))
    entity_of = lambda x: F.struct(
        x["name"].alias("entity"), x["tag"].alias("type"), x["n"].alias("counts"), day.alias("publish_date")
    )
    return whole.select(
        "url",
        F.struct(
            F.lit(source).alias("source"),
            "_a.*",
            F.transform(with_counts(words), word_of).alias("word_pos_frequency"),
            F.transform(with_counts(entities), entity_of).alias("named_entities"),
        ).alias("data"),
    )


def normalize_annotated(docs: DataFrame) -> dict[str, DataFrame]:
    """Annotated (url, data) documents to three flat tables."""
    words = docs.select("url", F.explode("data.word_pos_frequency").alias("_w"))
    entities = docs.select("url", F.explode("data.named_entities").alias("_e"))
    return {
        "article_info": docs.select("url", "data.publish_date", "data.title", "data.author"),
        "word_pos_frequency": words.select("url", "_w.word", "_w.pos", "_w.frequency"),
        "named_entities": entities.select("url", "_e.entity", "_e.type", F.col("_e.counts").alias("count")),
    }
