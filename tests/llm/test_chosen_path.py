"""Near-duplicate components against brute force on full sets."""

import random
import re

import pyarrow.parquet as pq
import pytest

from murmur.llm import chosen_path
from murmur.llm.components import components
from murmur.llm.queries import op10_near_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()


def brute(rows):
    """(doc_id, n, component, kept), from all pairs that share a shingle."""
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    where, owner = {}, {i: i for i, _ in sets}
    for k, (_, s) in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(k)

    def root(x):
        while owner[x] != x:
            x = owner[x]
        return x

    for k, (i, s) in enumerate(sets):
        common = {}
        for x in s:
            for j in where[x]:
                if j < k:
                    common[j] = common.get(j, 0) + 1
        for j, n in common.items():
            if 100 * n >= 85 * (len(s) + len(sets[j][1]) - n):
                a, b = sorted((root(i), root(sets[j][0])))
                owner[b] = a
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()))


def corpus(seed, groups, size, edits):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows = []
    for _ in range(groups):
        base = [r.choice(vocabulary) for _ in range(r.randint(40, 200))]
        for _ in range(r.randint(1, size)):
            w = list(base)
            for _ in range(r.randint(0, edits)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            rows.append(" ".join(w))
            if r.random() < 0.3:
                base = w  # chains
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("leaf", [1000, 6])
def test_groups_and_chains(spark, leaf):
    rows = corpus(1, 60, 25, 6)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(chosen_path.near_duplicates(docs, leaf=leaf)) == brute(rows)


def test_one_large_group(spark):
    r = random.Random(5)
    base = [f"w{r.randrange(3000)}" for _ in range(300)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(r.randint(0, 8)):
            w[r.randrange(300)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(400 + i, rows[0][1]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(chosen_path.near_duplicates(docs, leaf=40)) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (5, None), (6, ""), (7, " \t\n "), (8, "one"), (9, "ONE"), (10, "one two"), (11, "one\x0btwo"), (12, "two one"),
        (None, "one two"), (13, "a b c"), (14, "A\tB\nC"), (14, "a b c"), (15, "long " * 20000), (16, "x y z " * 3000),
        (17, "É b c"), (18, "é b c"), (19, "one two"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS digest", "1 AS rep", "2 AS kept")
    assert result(chosen_path.near_duplicates(docs)) == brute(rows)


def test_empty_table(spark):
    assert result(chosen_path.near_duplicates(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(250)] + [(i, i + 1) for i in range(400, 500)] + [(7, 7), (None, 3)]
    got = {a: b for a, b in components(spark.createDataFrame(links, "a long, b long")).collect()}
    owner = {x: x for p in links for x in p if None not in p}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a is not None and owner[a] != owner[b]:
                owner[a] = owner[b] = min(owner[a], owner[b])
                changed = True
    assert got == {x: m for x, m in owner.items() if x != m}


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()]
    assert result(op10_near_dedup(spark, "/root/testdata/sf0.01")) == brute(rows)
