"""Merkle manifest against a plain recursive version."""

import hashlib
import zlib

import pytest
from compare import connect, spark_rows, sql_rows
from pyspark.sql import functions as F

from murmur.llm.merkle import Manifest, folded, leaf, levels, path, regenerate
from murmur.llm.queries import ORACLE, op12_merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(*fields):
    return H(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree_of(nodes):
    rows = [nodes]
    while len(rows[-1]) > 1:
        rows.append([H(*rows[-1][i : i + 8]) for i in range(0, len(rows[-1]), 8)])
    return rows


def siblings(rows, at):
    out = []
    for row in rows[:-1]:
        run = row[at - at % 8 : at - at % 8 + 8]
        out.append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        at //= 8
    return out


def brute(rows):
    """(id, leaf, subroot, root, proof, folded, verified) of (id, group, text) rows; odd crc32 of the id is tampered."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(*r)))
        trees[g] = own, tree_of([brute_leaf(*r) for r in own])
    top = tree_of([trees[g][1][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        own, tree = trees[g]
        for i, r in enumerate(own):
            path = siblings(tree, i) + siblings(top, k)
            node = brute_leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                node = brute_leaf(r[0], r[1], r[2] and r[2].lower())
            for a, b in path:
                node = H(a, node, b)
            root = top[-1][0]
            out.append((r[0], brute_leaf(*r), tree[-1][0], root, H(*(a + b for a, b in path)), node, node == root))
    return sorted(out, key=repr)


def manifest(df):
    text = F.col("text")
    own = [F.col("doc_id"), F.col("lang")]
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, leaf(*own, F.lower(text)))
    return Manifest(df, F.col("lang"), F.col("doc_id"), leaf(*own, text), changed)


def result(df):
    names = ("id", "leaf", "subroot", "root", "proof", "folded", "verified")
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


ODD = [(1, "en", "A"), (1, "en", "A"), (1, "en", None), (None, "en", "B"), (None, None, "c"), (2, None, ""), (3, "", "D"), (4, "é", "x" * 100_000)]


@pytest.mark.parametrize(
    "rows",
    [
        ODD,
        [(7, "en", "Alone")],
        [(i, "en", f"T{i}") for i in range(600)] + [(i, "de", f"T{i}") for i in range(9)] + ODD,
        [(i, f"lang{i % 70:02d}", f"T{i}") for i in range(300)],
        [(i, "x", "Same") for i in range(513)],
    ],
    ids=["odd", "one", "two stored levels", "many groups", "one over a subtree"],
)
def test_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    for c in ("tree", "pos", "hash", "grp", "id"):  # names of the operator's own
        df = df.withColumn(c, F.lit("?"))
    assert result(manifest(df).audit()) == brute(rows)


def test_proofs_lead_to_the_root(spark):
    rows = [(i, "ab"[i % 2], f"t{i}") for i in range(100)]
    proofs = manifest(spark.createDataFrame(rows, "doc_id long, lang string, text string")).proofs().collect()
    assert len(proofs) == 100
    for r in proofs:
        assert folded(r.leaf, [(s.left, s.right) for s in r.siblings]) == r.root
        assert folded(H("other"), [(s.left, s.right) for s in r.siblings]) != r.root


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert manifest(df).audit().collect() == [] and manifest(df).proofs().collect() == []


def test_levels_and_paths():
    assert [levels(n) for n in (1, 2, 8, 9, 64, 65, 512, 513)] == [0, 1, 1, 2, 2, 3, 3, 4]
    tree = regenerate([H(str(i)) for i in range(100)], 3)
    assert [len(x) for x in tree] == [100, 13, 2, 1]
    assert all(folded(tree[0][i], path(tree, i)) == tree[3][0] for i in range(100))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    assert spark_rows(op12_merkle(spark, sf)) == sql_rows(connect(sf), ORACLE["op12_merkle"])
