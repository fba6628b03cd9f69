"""From raw documents to token ids: five stages, each over all that the one before has kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's docs. All but the last return
the columns of documents. Stages 2 to 4 work on a key of the row, so rows without a doc_id and rows that share one are
compared, cut and dropped like all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.llm import bpe, chosen_path, suffix_dedup, template, toxicity
from murmur.llm.common import partitions, store
from murmur.llm.queries import LEARN_THRESHOLD, prepare, table, tokenizer

# SQL can't express these stages; tests hold them against brute force.
ORACLE_SQL = None


KEY = "_row_key"


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows with a key each, in the order of doc_id, those without one last.

    The doc_id itself where no row lacks it and no two share it; else a number that is stored with the rows.
    """
    known = F.col("doc_id").cast("long")
    odd = docs.groupBy(known.alias("doc_id")).count().where("doc_id IS NULL OR count > 1")
    if odd.isEmpty():
        return docs.withColumn(KEY, known)
    place = [known.asc_nulls_last(), F.xxhash64("text"), F.col("_place")]
    rows = docs.withColumn("_place", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(partitions(docs), *place).sortWithinPartitions(*place)
    return store(rows.drop("_place").withColumn(KEY, F.monotonically_increasing_id()), "rows")


def _texts(keyed: DataFrame) -> DataFrame:
    return keyed.select(F.col(KEY).alias("doc_id"), "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    scored = toxicity.score_rows(docs, model)
    return scored.where(F.col("score") < LEARN_THRESHOLD).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest doc_id; five words, similarity 0.8."""
    rows = _keyed(docs)
    kept = chosen_path.near_duplicates(_texts(rows), width=5, percent=80).where("kept").select(F.col("doc_id").alias(KEY))
    return rows.join(kept, KEY, "left_semi").select(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; a text that was nothing else goes."""
    rows = _keyed(docs)
    cut = suffix_dedup.remove_repeats(_texts(rows), whole_letters=True)
    cut = cut.select(F.col("doc_id").alias("_id"), (F.size("spans") > 0).alias("_cut"), F.col("kept").cast("string").alias("_text"))
    # what is kept of every text moves, so the texts themselves need not; a null one is kept as an empty one
    others = rows.withColumn("_none", F.col("text").isNull()).drop("text")
    # Catalyst knows the size of the chunks' places, not of the texts read from them: never broadcast these
    joined = others.join(cut.hint("merge"), F.col(KEY) == F.col("_id")).where("NOT _cut OR _text <> ''")
    changed = {"text": F.when(~F.col("_none"), F.col("_text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(~F.col("_cut"), F.col("n_chars")).otherwise(F.length("_text").cast(kind))
    return joined.withColumns(changed).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    rows = _keyed(docs)
    bad = template.contaminated(_texts(rows), table(spark, sf_dir, "benchmark")).where("contaminated")
    return rows.join(bad.select(F.col("doc_id").alias(KEY)), KEY, "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): token ids and the text that they decode to."""
    path = tokenizer("byte_bpe_50k.json")
    done = bpe.round_trip(docs, path)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("repeated_passages", drop_repeats),
    ("decontamination", drop_contaminated),
    ("token_ids", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is stored before the next begins."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = store(docs, name)
    return docs
