"""Merkle manifest of a table: a tree of 8 children per node for each group, and one over the groups' roots.

A node is the SHA-256 (lower-case hex) of its children's digests as hex text. Leaves hash the fields of a row, each as its
number of bytes, ``:`` and its value, ``-`` where it is null. A group's leaves stand in the order of their id; runs of 8 become
one node, the last run may be shorter, until one node is left; a group of one leaf is its own root.

Checkpoint and recompute: only every third level is stored (``LEVELS``). The 512 nodes below a stored node are an aligned
subtree. Both ways through the tree handle a subtree at a time: upwards a task folds it to the next stored node; for proofs a
task regenerates the two levels between from the stored nodes below, emits each node's siblings and forgets them. What lies
above a subtree is the same for all its nodes and comes down with it as one row.

Rows are placed by a range partitioning on (group, id, leaf), and counted from the rows of each task before; no
task sees a whole group, and a group with a third of all rows spans as many tasks as its rows ask for.

Defined results: null groups form one group, the first; null ids come first within theirs. Equal ids stand in the order of
their leaves. A proof without siblings is the digest of nothing. An empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import batch, partitions, store
from murmur.llm.grouped import groups

ARITY = 8
LEVELS = 3  # of them one is stored
SUBTREE = ARITY**LEVELS
SIBLINGS = "array<struct<left:string,right:string>>"


def leaf(*fields: Column) -> Column:
    """Digest of a row's fields, as hex."""
    parts = []
    for f in fields:
        value = f.cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes: int) -> int:
    """Levels above so many nodes."""
    n = 0
    while nodes > 1:
        nodes, n = -(-nodes // ARITY), n + 1
    return n


def regenerate(nodes: list[str], depth: int) -> list[list[str]]:
    """The given nodes and ``depth`` levels above them."""
    out = [nodes]
    for _ in range(depth):
        below = out[-1]
        out.append([digest(below[i : i + ARITY]) for i in range(0, len(below), ARITY)])
    return out


def path(tree: list[list[str]], at: int) -> list[tuple[str, str]]:
    """Digests left and right of the node and of each node above it, within their runs."""
    out = []
    for row in tree[:-1]:
        first = at - at % ARITY
        out.append(("".join(row[first:at]), "".join(row[at + 1 : first + ARITY])))
        at //= ARITY
    return out


def folded(node: str, siblings: list[tuple[str, str]]) -> str:
    """The root that a node and its siblings give."""
    for left, right in siblings:
        node = hashlib.sha256(f"{left}{node}{right}".encode()).hexdigest()
    return node


def _depth(nodes: int) -> int:
    """Levels from stored nodes, ``nodes`` in the whole tree, to the next stored ones."""
    return min(LEVELS, levels(nodes))


def _above(nodes: int) -> int:
    return max(1, -(-nodes // SUBTREE))


# Nodes of trees: the tree, how many nodes it has at this level, and the node's place among them.
NODES = "tree long, nodes long, pos long, hash string"


def _by_subtree(nodes: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """The nodes of a subtree side by side in their order, behind the row of ``above`` that belongs to it."""
    rows = nodes.withColumn("kind", F.lit(1)).withColumn("block", F.floor(F.col("pos") / SUBTREE))
    if above is not None:
        rows = above.withColumn("kind", F.lit(0)).withColumnRenamed("pos", "block").unionByName(rows, allowMissingColumns=True)
    return rows.repartition(partitions(nodes), "tree", "block").sortWithinPartitions("tree", "block", "kind", "pos")


def _subtrees(batches):
    """One table per subtree."""
    for g in groups(batches, "tree"):
        yield from groups(g.to_batches(), "block")


def _stored_above(nodes: DataFrame) -> DataFrame:
    """The next stored level: every subtree folded to its top."""
    schema = pa.schema([("tree", pa.int64()), ("nodes", pa.int64()), ("pos", pa.int64()), ("hash", pa.string())])

    def run(batches):
        for g in _subtrees(batches):
            tree, block, n = (g.column(c)[0].as_py() for c in ("tree", "block", "nodes"))
            top = regenerate(g.column("hash").to_pylist(), _depth(n))[-1]
            yield batch(schema.names, [[tree], [_above(n)], [block], top], schema)

    return _by_subtree(nodes.select("tree", "nodes", "pos", "hash")).mapInArrow(run, NODES)


def _levels(nodes: DataFrame, most: int) -> list[DataFrame]:
    """The stored levels of all trees, the given one first; in the last each tree has one node."""
    out = [nodes]
    while most > 1:
        out.append(store(_stored_above(out[-1]), "nodes"))
        most = _above(most)
    return out


def _opened(batches):
    """(nodes of a subtree, the tree over them, what stands above them) of each subtree."""
    for g in _subtrees(batches):
        above, nodes = g.slice(0, 1).to_pylist()[0], g.slice(1)
        tree = regenerate(nodes.column("hash").to_pylist(), _depth(nodes.column("nodes")[0].as_py()))
        above["siblings"] = [(x["left"], x["right"]) for x in above["siblings"]]
        yield nodes, tree, above


INFO = pa.schema(
    [("tree", pa.int64()), ("pos", pa.int64()), ("subroot", pa.string()), ("root", pa.string()),
     ("siblings", pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))]
)
INFO_SQL = f"tree long, pos long, subroot string, root string, siblings {SIBLINGS}"


def _beneath(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Siblings of every node up to the root, roots included; ``above`` has the same of the next stored level."""

    def run(batches):
        for g, tree, top in _opened(batches):
            pos = g.column("pos").to_pylist()
            pairs = [[{"left": a, "right": b} for a, b in path(tree, i) + top["siblings"]] for i in range(len(pos))]
            n = len(pos)
            yield batch(INFO.names, [[g.column("tree")[0].as_py()] * n, pos, [top["subroot"]] * n, [top["root"]] * n, pairs], INFO)

    return _by_subtree(nodes.select("tree", "nodes", "pos", "hash"), above).mapInArrow(run, INFO_SQL)


def _ordered(rows: DataFrame, tree: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Stored rows in the order of tree and ``order``, with the task they are in and their place among its rows of a tree."""
    keys = [*(F.col(c).asc_nulls_first() for c in (*tree, *order)), F.col("_line")]
    # equal rows are told apart, so that many of them can lie in several tasks
    lined = rows.withColumn("_line", F.monotonically_increasing_id())
    ranged = lined.repartitionByRange(partitions(rows), *keys).sortWithinPartitions(*keys).drop("_line")

    def number(batches):
        part, last, idx = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            places = []
            columns = [b.column(b.schema.get_field_index(c)).to_pylist() for c in tree]
            for key in zip(*columns, strict=True) if columns else [()] * b.num_rows:
                if key != last:
                    last, idx = key, 0
                places.append(idx)
                idx += 1
            more = [pa.array([part] * b.num_rows, pa.int64()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, "_part", "_idx"])

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema.fields)
    return store(ranged.mapInArrow(number, f"{columns}, _part long, _idx long"), "ordered")


def _offsets(ordered: DataFrame, tree: Sequence[str]) -> DataFrame:
    """For each task and tree, the rows of the tree before it and in all: a row per task and tree, whatever their sizes."""
    sizes = ordered.groupBy("_part", *tree).agg((F.max("_idx") + 1).alias("_rows"))
    own = Window.partitionBy(*(tree or [F.lit(0)]))
    before = F.sum("_rows").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    return sizes.select("_part", *tree, F.coalesce(before, F.lit(0)).alias("_start"), F.sum("_rows").over(own).alias("nodes"))


def _placed(ordered: DataFrame, offsets: DataFrame, tree: Sequence[str]) -> DataFrame:
    """The rows with their ``pos`` in the tree and what else ``offsets`` has."""
    names = {c: f"_of{c}" for c in ("_part", *tree)}
    match = F.col("_part") == F.col("_of_part")
    for c in tree:
        match = match & F.col(c).eqNullSafe(F.col(f"_of{c}"))
    joined = ordered.join(offsets.withColumnsRenamed(names), match).withColumn("pos", F.col("_start") + F.col("_idx"))
    return joined.drop("_part", "_idx", "_start", *names.values())


class Manifest:
    """Stored levels of the trees over a table's rows."""

    def __init__(self, rows: DataFrame, group: Column, row_id: Column, row_leaf: Column, changed: Column | None = None):
        """``row_leaf`` is the digest of a row, ``changed`` that of a row as it is found later (null: as it was)."""
        self.spark = rows.sparkSession
        changed = F.lit(None).cast("string") if changed is None else changed
        given = rows.select(
            group.cast("string").alias("grp"), row_id.cast("long").alias("id"), row_leaf.alias("hash"), changed.alias("changed")
        )
        ordered = _ordered(store(given, "leaves"), ["grp"], ["id", "hash", "changed"])
        offsets = store(_offsets(ordered, ["grp"]), "offsets")
        trees = store(offsets.select("grp", F.col("nodes").alias("leaves")).distinct(), "groups")
        most, n = trees.agg(F.max("leaves"), F.count("*")).first()
        self.empty = not n
        if self.empty:
            return
        numbered = _ordered(trees, [], ["grp"])
        numbers = _placed(numbered, _offsets(numbered, []), []).select(F.col("grp").alias("_grp"), F.col("pos").alias("tree"))
        offsets = offsets.join(numbers, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp")
        self.levels = _levels(store(_placed(ordered, offsets, ["grp"]), "leaves"), most)
        tops = self.levels[-1].select(
            F.lit(0).cast("long").alias("tree"), F.lit(n).cast("long").alias("nodes"), F.col("tree").alias("pos"), "hash"
        )
        self.upper = _levels(store(tops, "roots"), n)

    def _above_leaves(self) -> DataFrame:
        """What stands above each subtree of leaves."""
        root = F.col("hash").alias("root")
        info = self.upper[-1].select("tree", "pos", root, F.lit(None).cast("string").alias("subroot"), F.array().cast(SIBLINGS).alias("siblings"))
        for nodes in self.upper[-2::-1]:
            info = _beneath(nodes, info)
        info = store(info.drop("subroot"), "above").alias("i").join(
            self.upper[0].select(F.col("pos").alias("_pos"), F.col("hash").alias("subroot")), F.col("pos") == F.col("_pos")
        )
        info = info.select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "subroot", "root", "siblings")
        for nodes in self.levels[-2:0:-1]:
            info = store(_beneath(nodes, info), "above")
        return info

    def proofs(self) -> DataFrame:
        """(grp, id, leaf, subroot, root, siblings): for every row the digests left and right of it, level by level."""
        schema = pa.schema([("grp", pa.string()), ("id", pa.int64()), ("leaf", pa.string()), *(INFO.field(c) for c in ("subroot", "root", "siblings"))])

        def run(batches):
            for g, tree, top in _opened(batches):
                n = g.num_rows
                pairs = [[{"left": a, "right": b} for a, b in path(tree, i) + top["siblings"]] for i in range(n)]
                columns = [*(g.column(c).to_pylist() for c in ("grp", "id", "hash")), [top["subroot"]] * n, [top["root"]] * n, pairs]
                yield batch(schema.names, columns, schema)

        return self._from_leaves(run, f"grp string, id long, leaf string, subroot string, root string, siblings {SIBLINGS}")

    def audit(self) -> DataFrame:
        """(grp, id, leaf, subroot, root, proof, folded, verified): digest of each row's proof, and the root that the
        row as it is now gives with the siblings as they were."""
        names = ["grp", "id", "leaf", "subroot", "root", "proof", "folded", "verified"]
        schema = pa.schema([(c, {"id": pa.int64(), "verified": pa.bool_()}.get(c, pa.string())) for c in names])

        def run(batches):
            for g, tree, top in _opened(batches):
                rest = "".join(a + b for a, b in top["siblings"])
                proof, fold = [], []
                for i, (own, now) in enumerate(zip(tree[0], g.column("changed").to_pylist(), strict=True)):
                    siblings = path(tree, i)
                    proof.append(digest([*(a + b for a, b in siblings), rest]))
                    fold.append(folded(own if now is None else now, siblings + top["siblings"]))
                n = len(proof)
                columns = [g.column("grp").to_pylist(), g.column("id").to_pylist(), tree[0], [top["subroot"]] * n, [top["root"]] * n]
                yield batch(names, [*columns, proof, fold, [x == top["root"] for x in fold]], schema)

        return self._from_leaves(run, "grp string, id long, leaf string, subroot string, root string, proof string, folded string, verified boolean")

    def _from_leaves(self, run, columns: str) -> DataFrame:
        if self.empty:
            return self.spark.createDataFrame([], columns)
        return _by_subtree(self.levels[0], self._above_leaves()).mapInArrow(run, columns)
