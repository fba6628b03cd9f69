"""Nearest neighbours by largest inner product, from a forest of hash prefixes.

Vectors are lengthened by one value so that all have the same norm; then the largest inner product is the
smallest angle. In each tree a vector has a string of 64 bits, the sides of random planes it lies on, and the
tree is the sorted array of these strings. A query descends in every tree to the longest prefix it
shares with some row; from there all trees ascend together, one bit at a time, until the rows that
share that many bits are a given share of the table, counted over all trees. These are the
candidates. They are scored exactly, in double precision, where they lie.

Arrays are cut into blocks by their first bits, and blocks with many rows into parts, so a task holds a
bounded number of rows even if all vectors are nearly the same. Rows with the same vector are one
entry with their smallest ids: more than the number asked for, plus the query's own, can't be in a result.

The share is a parameter because it buys recall: vectors without any structure, as in the test tables,
need most of a table for 0.9, others a small part. It holds alike at every size.

Vectors that are null, empty, zero or hold a null, NaN or infinity take no part, as queries neither;
rows without an id don't either; of different lengths only the most frequent (the longest of these) takes part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import batch, partitions, store
from murmur.llm.grouped import groups

TREES = 24
SHARE = 0.8
BITS = 64
BLOCK = 4096
SALTS = 1 << 20


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector array<double>) of the rows that take part."""
    given = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    given = given.where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    sizes = given.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    size = sizes.agg(F.max_by("size", F.struct("n", "size")).alias("size")).first()["size"]
    return given.where(F.size("vector") == F.lit(size or 0)).dropDuplicates(["vec_id", "vector"])


def _planes(tree: int, size: int) -> np.ndarray:
    return np.random.default_rng([7, tree]).standard_normal((size + 1, BITS))


def _hash(x: np.ndarray, extra: np.ndarray, tree: int) -> np.ndarray:
    """Strings of bits as integers, the first bit highest."""
    side = np.column_stack([x, extra]) @ _planes(tree, x.shape[1]) > 0
    return np.packbits(side, axis=1).view(">u8").ravel().astype(np.uint64)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _strings(rows: DataFrame, trees: int, longest: float, query: bool) -> DataFrame:
    """(tree, hash, rep, vector) of (rep, vector) in all trees; hashes are moved to signed order."""
    schema = pa.schema([("tree", pa.int32()), ("hash", pa.int64()), ("rep", pa.int64()), ("vector", pa.list_(pa.float64()))])

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 2000):
                part = b.slice(i, 2000)
                x = _matrix(part.column(1)) / longest
                norm = (x * x).sum(axis=1)
                if query:
                    x, extra = x / np.sqrt(norm)[:, None], np.zeros(len(x))
                else:
                    extra = np.sqrt(np.maximum(0, 1 - norm))
                for t in range(trees):
                    h = (_hash(x, extra, t) ^ np.uint64(1 << 63)).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), t, np.int32)), pa.array(h), part.column(0), part.column(1)], schema=schema
                    )

    return rows.select("rep", "vector").mapInArrow(run, "tree int, hash long, rep long, vector array<double>")


def _prefix(bits: int) -> Column:
    """The first bits of a hash as an integer."""
    return F.shiftright(F.col("hash"), BITS - bits) + (1 << (bits - 1)) if bits else F.lit(0).cast("long")


def _ranges(h: np.ndarray, q: np.ndarray, level: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds in the sorted hashes ``h`` of those that share ``level`` bits with each of ``q``."""
    u, level = (q.view(np.uint64) ^ np.uint64(1 << 63)), np.asarray(level)
    rest = np.where(level > 0, (np.uint64(1) << (BITS - np.maximum(level, 1)).astype(np.uint64)) - np.uint64(1), np.uint64(2**64 - 1))
    s = h.view(np.uint64) ^ np.uint64(1 << 63)
    return np.searchsorted(s, u & ~rest), np.searchsorted(s, u | rest, side="right")


def _both(items: DataFrame, asked: DataFrame, n: int) -> DataFrame:
    """Items and queries of each key together, items first and in order."""
    return items.unionByName(asked).repartition(n, "key").sortWithinPartitions("key", "kind", "hash", "rep")


def _counts(rows: DataFrame, bits: int) -> DataFrame:
    """(rep, level, n): how many items of a block share how many bits with a query, from ``bits`` on."""
    schema = pa.schema([("rep", pa.int64()), ("level", pa.int32()), ("n", pa.int64())])

    def run(batches):
        for g in groups(batches, "key"):
            kind, h, rep = (g.column(c).to_numpy() for c in ("kind", "hash", "rep"))
            q = kind == 1
            if not q.any():
                continue
            live = np.flatnonzero(q)
            for level in range(bits, BITS + 1):
                low, high = _ranges(h[~q], h[live], level)
                live, n = live[high > low], (high - low)[high > low]
                if not len(live):
                    break
                yield batch(schema.names, [rep[live], np.full(len(live), level, np.int32), n], schema)

    return rows.mapInArrow(run, "rep long, level int, n long")


def _best(rows: DataFrame, k: int) -> DataFrame:
    """(query, rep, score): of the items each query reaches under a key, those with the best scores."""
    schema = pa.schema([("query", pa.int64()), ("rep", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for g in groups(batches, "key"):
            kind, h, rep, level = (g.column(c).to_numpy() for c in ("kind", "hash", "rep", "level"))
            q = kind == 1
            if not q.any() or q.all():
                continue
            x = _matrix(g.column("vector").combine_chunks())
            items, reps, asked = x[~q], rep[~q], np.flatnonzero(q)
            low, high = _ranges(h[~q], h[q], level[q])
            for i in range(0, len(asked), 256):
                some = asked[i : i + 256]
                scores = x[some] @ items.T
                out: list[list] = [[], [], []]
                for j, a in enumerate(some.tolist()):
                    lo, hi = int(low[i + j]), int(high[i + j])
                    if hi <= lo:
                        continue
                    s = scores[j, lo:hi]
                    if len(s) > k:
                        # a little more than k, as scores that should be equal may differ in the last bit
                        bound = np.partition(s, len(s) - k)[len(s) - k]
                        best = np.flatnonzero(s >= bound - 1e-9 * max(1.0, abs(bound))) + lo
                    else:
                        best = np.arange(lo, hi)
                    exact = (items[best] * x[a]).sum(axis=1)
                    order = np.lexsort((reps[best], -exact))[:k]
                    out[0] += [int(rep[a])] * len(order)
                    out[1] += reps[best[order]].tolist()
                    out[2] += exact[order].tolist()
                yield batch(schema.names, out, schema)

    return rows.mapInArrow(run, "query long, rep long, score double")


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, trees: int = TREES, share: float = SHARE, block: int = BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each row that ``is_query`` holds for.

    ``is_query`` is a condition on vec_id. Fewer rows than ``k`` only where the table has no more.
    """
    spark = vectors.sparkSession
    given = store(usable(vectors), "vectors")
    order = Window.partitionBy("vector").orderBy("vec_id")
    # an id with a vector twice is one; WindowGroupLimit keeps k + 1 per task before the shuffle
    ranked = given.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    members = ranked.withColumn("rep", F.min("vec_id").over(Window.partitionBy("vector")))
    members = store(members.select("rep", "vec_id", "place", "vector"), "members")
    entries = members.where("place = 1").select(F.xxhash64("vector", "vec_id").alias("rep"), "vec_id", "vector")
    entries = store(entries, "entries")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    stats = entries.agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))).alias("m")).first()
    total, longest = stats["n"], stats["m"]
    if not total:
        return empty
    bits = max(0, int(np.ceil(np.log2(total / block)))) if total > block else 0
    n = partitions(entries)

    index = _strings(entries, trees, longest, query=False).withColumn("block", _prefix(bits))
    index = store(index, "index")
    sizes = index.groupBy("tree", "block").agg(F.count("*").alias("n"))
    parts = store(sizes.withColumn("parts", F.ceil(F.col("n") / block).cast("int")), "blocks")
    key = F.xxhash64("tree", "block", "part").alias("key")
    none = F.lit(None).cast("array<double>").alias("vector")
    items = index.join(parts, ["tree", "block"]).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))

    wanted = given.where(is_query).select("vec_id", "vector")
    classes = wanted.select("vector").distinct().join(entries.select("rep", "vector"), "vector")
    asked = store(_strings(classes, trees, longest, query=True).withColumn("block", _prefix(bits)), "queries")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")

    # how many rows share each number of bits: within blocks from the arrays, above them from the blocks' sizes
    own = asked.join(parts, ["tree", "block"]).select("tree", "block", "hash", "rep", every)
    inner = _both(
        items.select(key, F.lit(0).alias("kind"), "hash", "rep"), own.select(key, F.lit(1).alias("kind"), "hash", "rep"), n
    )
    counts = _counts(inner, bits)
    if bits:
        level = F.explode(F.sequence(F.lit(0), F.lit(bits - 1))).alias("level")
        at = F.expr(f"shiftright(block, {bits} - level)").alias("prefix")
        above = parts.select("tree", "block", "n", level).select("tree", "level", at, "n")
        above = above.groupBy("tree", "level", "prefix").agg(F.sum("n").alias("n"))
        outer = asked.select("tree", "block", "rep", level).select("tree", "level", at, "rep")
        counts = counts.unionByName(outer.join(above, ["tree", "level", "prefix"]).select("rep", "level", "n"))
    reached = counts.groupBy("rep", "level").agg(F.sum("n").alias("n"))
    goal = max(2 * k + 2, share * total)
    # where even all trees' roots hold less, all of them are taken
    stop = reached.groupBy("rep").agg(F.coalesce(F.max(F.when(F.col("n") >= goal, F.col("level"))), F.lit(0)).alias("level"))

    visits = asked.join(stop, "rep")
    if bits:
        first = F.expr(f"shiftleft(shiftright(block, greatest({bits} - level, 0)), greatest({bits} - level, 0))")
        last = first + F.expr(f"shiftleft(1L, greatest({bits} - level, 0)) - 1")
        visits = visits.withColumn("block", F.explode(F.sequence(first, last)))
    visits = visits.join(parts, ["tree", "block"]).select("tree", "block", "hash", "rep", "level", "vector", every)
    found = _best(
        _both(
            items.select(key, F.lit(0).alias("kind"), "hash", "rep", F.lit(0).alias("level"), "vector"),
            visits.select(key, F.lit(1).alias("kind"), "hash", "rep", "level", "vector"),
            n,
        ),
        k + 1,
    )
    # the best entries of each query, then their rows without the query's own
    found = found.groupBy("query", "rep").agg(F.max("score").alias("score"))
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = found.join(entries.select("rep", F.col("vec_id"), "vector"), "rep")
    found = found.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= k + 1)
    rows = found.select("query", "score", "vector").join(members.select("vector", F.col("vec_id").alias("near")), "vector")
    ids = wanted.join(entries.select(F.col("rep").alias("query"), "vector"), "vector").select("vec_id", "query")
    pairs = ids.join(rows.select("query", "score", "near"), "query").where("vec_id <> near")
    last = Window.partitionBy("vec_id").orderBy(F.desc("score"), "near")
    pairs = pairs.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    return pairs.select(F.col("vec_id").alias("query_id"), "rank", F.col("near").alias("vec_id"), "score")
