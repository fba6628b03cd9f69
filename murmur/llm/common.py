"""What several operators share: inputs, sizes, folds and bounded samples."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.session import shared_dir

PARTITION_BYTES = 64 << 20
MARKED = 1 << 24  # bits that tell which keys are wanted, 2 MB


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) of any table; a null text is empty, other columns stay behind."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def partitions(df: DataFrame, target: int = PARTITION_BYTES) -> int:
    """Number of partitions: the session's, or more where the bytes of the tables read ask for it."""
    held = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    # the tables themselves: an estimate of what a join makes of them is their product
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = sum(x for x in sizes if x < 1 << 60)  # the rest have no estimate
    return max(held, min(known // target, 200_000))


def fold(column: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; an id that is null is in no fold (null)."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(column.cast("string").cast("binary")) % parts


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*stored: DataFrame) -> None:
    """Delete tables that ``store`` wrote and that nothing reads any more."""
    for df in stored:
        for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
            fs, inner = pafs.FileSystem.from_uri(folder)
            fs.delete_dir(inner)


def among(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key is one of ``wanted`` (a column of the same type), and a few others by chance.

    What a join with ``wanted`` need not move stays behind. Keys are marked in a bitmap of at most 2 MB that all
    tasks get; with very many of them more rows pass, so the join has the last word.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(MARKED))
    marked = wanted.select(place(wanted.columns[0]).alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias("_map"))
    maps = marked.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    placed = rows.withColumn("_place", place(key)).withColumn("_map", F.bitmap_bucket_number("_place"))
    bit = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return placed.join(F.broadcast(maps), "_map").where(F.getbit(byte, (bit % 8).cast("int")) == 1).select(*rows.columns)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def sampled(df: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows, or all where there are fewer: those whose doc_id has a small hash.

    The bound on the hash comes from a count, so tasks pass on no more than is asked for in all.
    """
    n = df.count()
    if n <= rows:
        return df
    parts = 1 << 30
    return df.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < int(parts * rows / n))


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, keep: Column, rows: int) -> DataFrame:
    """(doc_id, label, text, part) of about ``rows`` documents of either class, with their whole texts.

    The sample does not depend on the partitions. Rows without an id, a text or a label of 0 or 1 take no part, nor do
    ids with both labels; of several texts with one id the smallest counts. ``part`` (0, 1 or 2) deals the documents
    out evenly. What comes back is bounded by ``rows``, so it is spread over the session's partitions.
    """
    given = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    given = given.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & keep)
    given = given.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_other"))
    given = given.where("label = _other").drop("_other")
    ids = sampled(given.where("label = 0"), rows).unionByName(sampled(given.where("label = 1"), rows))
    # ids are at most some 2 * rows, a known bound
    found = texts(docs).where("text <> ''").join(F.broadcast(ids), "doc_id")
    found = found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    found = found.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)).cast("int"))
    return found.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id")


def share(labels: DataFrame, label: str, keep: Column) -> float | None:
    """Share of ones among the kept labels, over all of them."""
    given = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & keep)
    return given.agg(F.avg(F.col(label).cast("double"))).first()[0]


def to_share(weights: np.ndarray, y: np.ndarray, true: float | None) -> tuple[float, ...]:
    """Move the constant of a logistic fit from the sample's share of ones to the true one."""
    w = [float(v) for v in weights]
    if true is not None and 0 < true < 1 and 0 < y.mean() < 1:
        w[0] += float(np.log(true / (1 - true)) - np.log(y.mean() / (1 - y.mean())))
    return tuple(w)


def runs(items: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts with at most ``limit`` characters in all, one text at least."""
    start = total = 0
    for i, x in enumerate(items):
        if total and total + len(x) > limit:
            yield start, i
            start, total = i, 0
        total += len(x)
    if start < len(items):
        yield start, len(items)


def batch(names: Iterable[str], columns: Iterable, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, schema.field(n).type) for n, c in zip(names, columns, strict=True)], schema=schema
    )


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser that spreads every bit of the input over the output."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Weights (first the constant) of a logistic fit with a small ridge, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x]).astype(float)
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1]) * 1e-2
    for _ in range(rounds):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, x.T @ (y - p) - ridge @ w)
        size = np.abs(step).max()
        w += step if size < 4 else step * (4 / size)
        if size < 1e-8:
            break
    return w


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))
