"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.llm import align, bpe, chat, chosen_path, exact_dedup, forest, langid, merkle, quality, suffix_dedup, template, tokenfile, toxicity
from murmur.llm.common import fold, new_folder, sampled
from murmur.session import SETTINGS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
LEARN_THRESHOLD = 0.3


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def prepare(spark: SparkSession) -> None:
    """The library's settings, and batches that hold some megabytes of text rather than tens."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def query(fn: Callable[[SparkSession, str], DataFrame]):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _judged(scores: DataFrame, held: int, parts: int) -> DataFrame:
    return scores.select(
        "doc_id",
        (fold("doc_id", parts) == held).alias("held_out"),
        "score",
        (F.col("score") >= LEARN_THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = tokenfile.write(docs, new_folder(spark, "tokens"), tokenizer("word_bpe_49k.json"))
    return tokenfile.read(manifest).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, fold("doc_id", 4) != 2)
    return _judged(toxicity.score(docs, model), 2, 4)


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, fold("doc_id", 5) != 0)
    return _judged(quality.score(docs, model), 0, 5)


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("byte_bpe_50k.json")
    done = bpe.round_trip(table(spark, sf_dir, "documents"), path)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, fold("doc_id", 3) != 1)
    out = langid.predict(docs, model)
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


# How transcripts of the conversations name their speakers; in the last style nobody is named.
STYLES = (
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "Instructions: ", "user": "Human: ", "assistant": "AI: "},
    {"system": "[system] ", "user": "[user] ", "assistant": "[assistant] "},
    {"system": "Context: ", "user": "Q: ", "assistant": "A: "},
    {"system": "<|system|> ", "user": "<|user|> ", "assistant": "<|assistant|> "},
    {},
)
TURNS_IN_PART = 64


def spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, role, line): the turns of all conversations as a plain transcript has them."""
    c = table(spark, sf_dir, "conversations")
    style = F.crc32(F.col("conv_id").cast("string").cast("binary")) % len(STYLES)
    mark = F.lit("")
    for i, names in enumerate(STYLES):
        for role, name in names.items():
            mark = F.when((style == i) & (F.col("role") == role), name).otherwise(mark)
    lead = F.when(style >= 3, "\n").otherwise("")
    return c.select("conv_id", "turn", "role", F.concat(lead, mark, F.coalesce("text", F.lit(""))).alias("line"))


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.in_parts(spoken(spark, sf_dir), TURNS_IN_PART)
    picked = sampled(turns.select(F.col("conv_id").alias("doc_id")).distinct(), chat.SAMPLE)
    model = chat.fit_parts(turns.join(picked, turns["conv_id"] == picked["doc_id"], "left_semi"))
    own = F.array_sort(F.collect_list(F.struct("place", "line")))
    parts = turns.groupBy("conv_id", "part").agg(F.array_join(F.transform(own, lambda t: t["line"]), "\n").alias("text"))
    return chat.render(chat.parse(parts, model))


@query
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE["op11_exact_dedup"] = """
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(max(doc_id) OVER same AS BIGINT) AS keep_id,
       count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the fields of a leaf, in this order
    def leaf(text):
        return merkle.leaf(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), text)

    text = F.col("text")
    small = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(fold("doc_id", 3) == 0, leaf(small))
    tree = merkle.Manifest(table(spark, sf_dir, "documents"), F.col("lang"), F.col("doc_id"), leaf(text), tampered)
    return tree.audit().select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), F.col("folded").alias("folded_root"), "verified"
    )


def _merkle_sql(below: int = 7, upper: int = 3) -> str:
    """The whole tree, level by level: enough levels for 8 ** below rows of a language and 8 ** upper languages."""

    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(octet_length(encode(CAST({c} AS VARCHAR))), ':', {c}) END"

    def leaf(text: str) -> str:
        return "sha256(concat(" + ", ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + "))"

    crc = (
        "xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT)),"
        " lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: i::UBIGINT)),"
        " lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END)), 4294967295::UBIGINT)"
    )
    small = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = [
        f"t0 AS (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(small)} END AS changed FROM documents)",
        "d0 AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM t0)",
        "n0 AS (SELECT tree, pos, leaf AS hash FROM d0)",
    ]
    for k in range(1, below + 1):
        # a tree of one node stays as it is
        out.append(f"s{k} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM n{k - 1})")
        out.append(
            f"n{k} AS (SELECT tree, pos // 8 AS pos, CASE WHEN max(n) = 1 THEN min(hash) ELSE sha256(string_agg(hash, '' ORDER BY pos)) END AS hash"
            f" FROM s{k} GROUP BY tree, pos // 8)"
        )
    out.append(f"n{below + 1} AS (SELECT 0 AS tree, tree AS pos, hash FROM n{below})")
    for k in range(below + 2, below + upper + 2):
        out.append(f"s{k} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM n{k - 1})")
        out.append(
            f"n{k} AS (SELECT tree, pos // 8 AS pos, CASE WHEN max(n) = 1 THEN min(hash) ELSE sha256(string_agg(hash, '' ORDER BY pos)) END AS hash"
            f" FROM s{k} GROUP BY tree, pos // 8)"
        )
    # siblings of every node of a level, and whether the level exists in its tree
    for k in [*range(1, below + 1), *range(below + 2, below + upper + 2)]:
        out.append(
            f"p{k} AS (SELECT a.tree, a.pos, coalesce(string_agg(b.hash, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,"
            f" coalesce(string_agg(b.hash, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r, max(a.n) > 1 AS real"
            f" FROM s{k} a JOIN s{k} b ON a.tree = b.tree AND a.pos // 8 = b.pos // 8 GROUP BY a.tree, a.pos)"
        )
    out.append("f0 AS (SELECT doc_id, leaf, tree, pos, tree AS own, '' AS proof, coalesce(changed, leaf) AS hash FROM d0)")
    last = 0
    for k in [*range(1, below + 1), *range(below + 2, below + upper + 2)]:
        place = "f.own AS tree, p.pos // 8 AS pos" if k <= below else "p.tree, p.pos // 8 AS pos"
        on = "f.tree = p.tree AND f.pos = p.pos" if k <= below else "p.tree = 0 AND p.pos = " + ("f.own" if k == below + 2 else "f.pos")
        out.append(
            f"f{k} AS (SELECT f.doc_id, f.leaf, {place}, f.own, f.proof || p.l || p.r AS proof,"
            f" CASE WHEN real THEN sha256(p.l || f.hash || p.r) ELSE f.hash END AS hash FROM f{last} f JOIN p{k} p ON {on})"
        )
        last = k
    return (
        "WITH " + ",\n".join(out) + f"\nSELECT CAST(doc_id AS BIGINT) AS doc_id, leaf, s.hash AS subroot, r.hash AS root, sha256(proof) AS proof_sha256,"
        f" f.hash AS folded_root, f.hash = r.hash AS verified FROM f{last} f JOIN n{below} s ON s.tree = f.own CROSS JOIN n{below + upper + 1} r"
    )


ORACLE["op12_merkle"] = _merkle_sql()


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
