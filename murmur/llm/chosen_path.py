"""Near-duplicates by a chosen-path set similarity join.

Every text is a set of word shingles. Texts with the same set are one class, which its smallest doc_id
stands for. A class has a sketch of 256 minwise values. In each tree a node chooses one or two
of 128 places, and its classes move on to the children named by the minwise tokens they have there, so
similar classes stay together with a probability no less than their similarity at each step. A class's way follows from
its own sketch and the nodes that branch, so no sketch moves for it; comparisons move the 128 bytes that trees don't use.
Nodes of at most ``LEAF`` classes are compared exhaustively on their sketches; larger ones branch
again, up to ``DEPTH`` times, and what is larger still is compared in blocks. Trees
are independent; with 12 a pair at the bound shares a leaf with a probability above 0.999999 where one
branching is enough, and 0.998 where three are needed.

Sketches only propose: leaves name the classes that have a likely link, these bring their full sets, and
the sets decide. As components are what is asked for, a comparison tries the likeliest
links first and passes over what is joined already, so no group lists all its pairs. The first trees'
leaves are compared first; the others then look at pairs of different components that have not met before. They are grown
with the components known by then: a node that holds classes of a single component can join nothing and is dropped before its
rows are looked up or branch again, so a large group that the first trees have joined goes through no other tree.

A null or empty text, and one without words, has no set and is linked with nothing. Rows without a
doc_id are left out. Rows with the same doc_id and different texts are one node, linked through either.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import among, batch, discard, mix, partitions, store, texts
from murmur.llm.components import components
from murmur.llm.grouped import groups
from murmur.llm.shingles import sets

WIDTH = 3  # words in a shingle
PERCENT = 85  # of the union that the intersection must reach
PLACES = 128
TREES = 12
FIRST_TREES = 2  # whose leaves are compared before the others
LEAF = 1_000
DEPTH = 4
SLACK = 4.0  # standard deviations under the bound below which equal values of two sketches propose no link
MULTIPLIERS = mix(np.arange(1, 2 * PLACES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def sketch(s: np.ndarray) -> bytes:
    """The smallest value of the set under each of 256 hash functions.

    Of the first 128, by which trees branch, 32 bits each; of the others 8, for comparisons only.
    """
    least = np.full(2 * PLACES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 1024):
        least = np.minimum(least, (s[i : i + 1024, None] * MULTIPLIERS).min(axis=0))
    narrow = (mix(least[PLACES:]) >> np.uint64(56)).astype(np.uint8)
    return (least[:PLACES] >> np.uint64(32)).astype("<u4").tobytes() + narrow.tobytes()


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, digest, sketch); digest and sketch are null for an empty set."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("sketch", pa.binary())])

    def run(batches):
        for b in batches:
            ids, items = b.column(0), b.column(1).to_pylist()
            for i in range(0, len(items), 500):
                found = sets(items[i : i + 500], width)
                digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in found]
                marks = [sketch(s) if len(s) else None for s in found]
                yield batch(schema.names, [ids.slice(i, len(found)), [len(s) for s in found], digests, marks], schema)

    given = texts(docs).where("doc_id IS NOT NULL")
    return given.mapInArrow(run, "doc_id long, n_shingles long, digest binary, sketch binary")


def _children(classes: DataFrame, percent: int, roots: dict[int, int], opened: list) -> DataFrame:
    """(node, tree, rep, comp) of the level below the nodes ``opened`` last, of (rep, comp, sketch).

    ``roots`` has the root of each tree, ``opened`` for each level above the nodes (broadcast) that branch again. The way
    of a class follows from its sketch alone, so nothing moves.
    """
    schema = pa.schema([("node", pa.int64()), ("tree", pa.int32()), ("rep", pa.int64()), ("comp", pa.int64())])
    extra = 100 / percent - 1  # how often a node chooses a second place

    def step(marks, node, at):
        first = mix(node ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        one = first % np.uint64(PLACES)
        two = (one + np.uint64(1) + (first >> np.uint64(20)) % np.uint64(PLACES - 1)) % np.uint64(PLACES)
        on = (first >> np.uint64(40)) % np.uint64(1000) < np.uint64(int(extra * 1000))
        place, node, at = np.append(one, two[on]), np.append(node, node[on]), np.append(at, at[on])
        return mix(mix(node + place) + marks[at, place.astype(np.int64)].astype(np.uint64)), at

    def run(batches):
        large = [x.value for x in opened]
        for b in batches:
            if not b.num_rows:
                continue
            marks = np.array([np.frombuffer(x, "<u4", PLACES) for x in b.column(2).to_pylist()])
            for tree, root in roots.items():
                node, at = step(marks, np.full(b.num_rows, root, np.int64).view(np.uint64), np.arange(b.num_rows))
                for nodes in large:
                    more = np.isin(node, nodes)
                    node, at = step(marks, node[more], at[more])
                places = pa.array(at)
                yield batch(schema.names, [node.view(np.int64), np.full(len(at), tree, np.int32), b.column(0).take(places), b.column(1).take(places)], schema)

    return classes.select("rep", "comp", "sketch").mapInArrow(run, "node long, tree int, rep long, comp long")


def leaves(classes: DataFrame, percent: int = PERCENT, trees: int = TREES, leaf: int = LEAF, depth: int = DEPTH, since: int = 0) -> DataFrame:
    """(node, tree, size, rep, comp) of all nodes that are to be compared, each set of classes once.

    Nodes above ``leaf`` are those that still hold too many after ``depth`` branchings. Trees are those from ``since`` on.
    ``comp`` of ``classes`` (rep, sketch, comp) is a class's component as far as it is known; nodes of one component are none.
    """
    spark = classes.sparkSession
    names = spark.range(0, 1, 1, 1).select(*(F.xxhash64(F.lit("root"), F.lit(i)) for i in range(since, trees))).first()
    roots = dict(zip(range(since, trees), names, strict=True))
    opened, made, held_at = [], [], []
    levels = nodes = None
    for d in range(1, depth + 1):
        level = store(_children(classes, percent, roots, opened), "level")
        sizes = level.groupBy("node").agg(
            F.count("*").alias("size"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("members"), F.min("tree").alias("tree"),
            F.min("comp").alias("least"), F.max("comp").alias("most"),
        )
        held = store(sizes.where("least < most").drop("least", "most"), "nodes")
        made, held_at = [*made, level], [*held_at, held]
        # at most one for every ``leaf`` rows of the level
        more = np.empty(0, np.int64) if d == depth else held.where(F.col("size") > leaf).select("node").toArrow()["node"].to_numpy()
        last = not len(more)
        small = held if last else held.where(F.col("size") <= leaf)
        levels = level if levels is None else levels.unionByName(level)
        nodes = small if nodes is None else nodes.unionByName(small)
        if last:
            break
        opened.append(spark.sparkContext.broadcast(np.sort(more).view(np.uint64)))
    # a set of classes that stays whole is the same on several levels too
    once = nodes.groupBy("size", "members").agg(F.min_by("node", F.struct("tree", "node")).alias("node"))
    found = store(levels.join(once.select("node", "size"), "node").select("node", "tree", "size", "rep", "comp"), "leaves")
    discard(*made, *held_at)
    return found


class Group:
    """Classes that are compared with one another, and their likely links."""

    def __init__(self, g: pa.Table, percent: int):
        self.percent = percent
        self.rep, self.n, self.comp = (g.column(c).to_numpy() for c in ("rep", "n_shingles", "comp"))
        raw = np.frombuffer(b"".join(g.column("sketch").to_pylist()), np.uint8).reshape(len(self.rep), -1)
        self.values = raw[:, -PLACES:]  # of a whole sketch, those that no tree branches by
        self.done = g.column("done").to_pylist()

    def likely(self) -> np.ndarray:
        """Rows (equal places, i, k) of pairs of different components that were not compared before."""
        _, at, counts = np.unique(self.comp, return_inverse=True, return_counts=True)
        found = [np.zeros((0, 3), np.int64)]
        percent, p = self.percent, self.percent / 100
        lowest = PLACES * (p - SLACK * (p * (1 - p) / PLACES) ** 0.5)
        if len(counts) > 1:
            # of components, one end of every link is outside the largest
            inner = at == counts.argmax()
            place = np.arange(len(at))
            for i in np.flatnonzero(~inner).tolist():
                k = np.flatnonzero((at != at[i]) & (inner | (place > i)))
                k = k[100 * np.minimum(self.n[k], self.n[i]) >= percent * np.maximum(self.n[k], self.n[i])]
                same = (self.values[k] == self.values[i]).sum(axis=1)
                hit = same >= lowest
                k, same = k[hit], same[hit]
                mine = set(self.done[i] or ())
                if mine:
                    new = np.array([mine.isdisjoint(self.done[x] or ()) for x in k.tolist()], bool)
                    k, same = k[new], same[new]
                found.append(np.column_stack([same, np.full(len(k), i), k]).astype(np.int64))
        return np.concatenate(found)


ASKED = "key long, rep long, n_shingles long, comp long, sketch binary, done array<long>"


def _likely(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """The rows of all classes that a comparison under the key would have to look at."""

    def run(batches):
        for g in groups(batches, "key"):
            group = Group(g, percent)
            pairs = group.likely()
            if len(pairs):
                # rows that share a doc_id are one node: all of them
                yield from g.filter(pa.array(np.isin(group.rep, group.rep[pairs[:, 1:].ravel()]))).to_batches()

    placed = rows.select("key", "rep", "n_shingles", "comp", "sketch", "done").repartition(n, "key").sortWithinPartitions("key", "rep")
    return placed.mapInArrow(run, ASKED)


def _confirmed(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b) of rows with full sets: components that links join which the sets confirm, with the smallest one under the key.

    The likeliest are tried first; a pair that is joined by then needs no look.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for g in groups(batches, "key"):
            group = Group(g, percent)
            pairs = group.likely()
            full = [np.frombuffer(x, np.uint64) for x in g.column("shingles").to_pylist()]
            owner: dict[int, int] = {}

            def root(x, owner=owner):
                while owner.get(x, x) != x:
                    owner[x] = owner.get(owner[x], owner[x])
                    x = owner[x]
                return x

            comp = group.comp.tolist()
            for _, i, k in pairs[np.argsort(-pairs[:, 0], kind="stable")].tolist():
                x, y = root(comp[i]), root(comp[k])
                if x == y:
                    continue
                common = len(np.intersect1d(full[i], full[k], assume_unique=True))
                if 100 * common >= percent * (len(full[i]) + len(full[k]) - common):
                    owner[max(x, y)] = min(x, y)
            # stars, not the chains that the links make: few rounds lead to their components
            if owner:
                yield batch(schema.names, zip(*((x, root(x)) for x in list(owner)), strict=True), schema)

    return rows.repartition(n, "key").sortWithinPartitions("key", "rep").mapInArrow(run, "a long, b long")


def _full(docs: DataFrame, asked: DataFrame, width: int) -> DataFrame:
    """The rows asked for, each with the full set (shingles) of its class; a text is read once for all its keys."""
    kept = ["keys", "marks", "comp", "done"]

    def run(batches):
        for b in batches:
            ids, items = b.column(0), b.column(1).to_pylist()
            for i in range(0, len(items), 500):
                found = [s.tobytes() for s in sets(items[i : i + 500], width)]
                rest = [b.column(c).slice(i, len(found)) for c in range(2, 2 + len(kept))]
                yield pa.RecordBatch.from_arrays([ids.slice(i, len(found)), *rest, pa.array(found, pa.binary())], ["rep", *kept, "shingles"])

    by_rep = asked.groupBy(F.col("rep").alias("doc_id")).agg(
        F.collect_set("key").alias("keys"), F.collect_set(F.struct("n_shingles", "sketch")).alias("marks"),
        F.first("comp").alias("comp"), F.first("done").alias("done"),
    )
    schema = "rep long, keys array<long>, marks array<struct<n_shingles:long,sketch:binary>>, comp long, done array<long>, shingles binary"
    # few texts are asked for: the others don't move
    found = among(texts(docs), "doc_id", asked.select("rep")).join(by_rep, "doc_id").select("doc_id", "text", *kept).mapInArrow(run, schema)
    found = found.select(F.explode("keys").alias("key"), "rep", "marks", "comp", "done", "shingles")
    return found.select("key", "rep", F.inline("marks"), "comp", "done", "shingles")


def _keys(held: DataFrame, first: bool, leaf: int) -> DataFrame:
    """Rows of leaves dealt to the keys under which they are compared.

    A small leaf is one key. Of a large one, the first round compares blocks, each together with the leaf's
    first block, which leaves one large component where the classes are much alike; later
    rounds compare the blocks of what is outside that component with the blocks of all.
    """
    small = held.where(F.col("size") <= leaf).select(F.col("node").alias("key"), "rep", "comp")
    large = held.where(F.col("size") > leaf)
    blocks = F.ceil(F.col("size") / leaf).cast("int")
    part = F.pmod(F.xxhash64("rep", F.lit(1)), blocks).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    if first:
        own = large.select("node", part.alias("p"), "rep", "comp")
        lead = large.where(part == 0).select("node", every(blocks).alias("p"), "rep", "comp").where("p > 0")
        dealt = own.unionByName(lead).select(F.xxhash64("node", "p").alias("key"), "rep", "comp")
    else:
        counts = large.groupBy("node", "comp").agg(F.count("*").alias("n"))
        main = counts.groupBy("node").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), (F.sum("n") - F.max("n")).alias("rest"))
        joined = large.join(main, "node")
        rest = F.greatest(F.ceil(F.col("rest") / leaf), F.lit(1)).cast("int")
        q = F.pmod(F.xxhash64("rep", F.lit(2)), rest).cast("int")
        all_rows = joined.select("node", part.alias("p"), every(rest).alias("q"), "rep", "comp")
        outer = joined.where("comp <> main").select("node", part.alias("own"), every(blocks).alias("p"), q.alias("q"), "rep", "comp")
        dealt = all_rows.unionByName(outer.where("p <> own").drop("own")).select(F.xxhash64("node", "p", "q").alias("key"), "rep", "comp")
    return small.unionByName(dealt)


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, leaf: int = LEAF, trees: int = TREES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of ``docs`` with a doc_id."""
    n = partitions(texts(docs))
    marks = store(sketches(docs, width), "sketches")
    classes = marks.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
    )
    classes = store(classes, "classes")
    rows = marks.select("doc_id", "n_shingles", "digest").join(classes.select("digest", "rep"), "digest", "left")
    rows = store(rows.select("doc_id", "n_shingles", "rep"), "rows")
    discard(marks)
    # comparisons get only the values that no tree branches by
    short = classes.select("rep", "n_shingles", F.substring("sketch", 4 * PLACES + 1, PLACES).alias("sketch"))

    def compared(dealt: DataFrame) -> DataFrame:
        asked = store(_likely(dealt, n, percent), "asked")
        sure = store(_confirmed(_full(docs, asked, width), n, percent), "sure")
        found = components(sure).select(F.col("a").alias("rep"), F.col("b").alias("comp"))
        discard(asked, sure)
        return found

    nodes = leaves(classes.select("rep", "sketch", F.col("rep").alias("comp")), percent, min(trees, FIRST_TREES), leaf)
    dealt = _keys(nodes, True, leaf)
    done = dealt.groupBy("rep").agg(F.collect_set("key").alias("done"))
    # (rep, comp) of classes that are not their component's smallest
    labels = compared(dealt.join(short, "rep").withColumn("done", F.lit(None).cast("array<long>")))
    # the first trees' large leaves are not through yet
    held = nodes.drop("comp").join(labels, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    mixed = held.groupBy("node").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least < most")
    held = store(held.join(mixed.select("node"), "node", "left_semi"), "held")
    made = [nodes, held]
    if trees > FIRST_TREES:
        known = classes.select("rep", F.substring("sketch", 1, 4 * PLACES).alias("sketch")).join(labels, "rep", "left")
        known = store(known.withColumn("comp", F.coalesce("comp", "rep")), "known")
        later = leaves(known, percent, trees, leaf, since=FIRST_TREES)
        discard(known)
        held, made = held.unionByName(later), [*made, later]
    more = compared(_keys(held, False, leaf).join(short, "rep").join(done, "rep", "left"))
    discard(classes, *made)
    # these join components, by the names they had
    further = more.select(F.col("rep").alias("comp"), F.col("comp").alias("joined"))
    labels = labels.join(further, "comp", "left").select("rep", F.coalesce("joined", "comp").alias("comp")).unionByName(more)
    comp = F.coalesce("comp", "rep", "doc_id")
    out = rows.join(labels, "rep", "left")
    return out.select("doc_id", "n_shingles", comp.alias("component_id"), (F.col("doc_id") == comp).alias("kept"))
