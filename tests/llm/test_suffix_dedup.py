"""Repeated passages against brute force, and the sorter by itself."""

import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from murmur.llm import suffix_dedup
from murmur.llm.deep_shallow import equal_groups
from murmur.llm.queries import op2_suffix_dedup


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, sha) by a table of all 50-byte strings."""
    raw = [(i, (t or "").encode()) for i, t in rows if i is not None]
    first = {}
    for i, b in raw:
        for k in range(len(b) - 49):
            s = b[k : k + 50]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    out = []
    for r in df.collect():
        removed = sum(s.stop - s.start for s in r.spans)
        out.append((r.doc_id, r.n_bytes, removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("length,alphabet", [(50, 2), (50, 256), (7, 2), (17, 3), (8, 2)])
def test_equal_groups(length, alphabet):
    r = np.random.default_rng(length + alphabet)
    flat = r.integers(0, alphabet, 6000).astype(np.uint8)
    for _ in range(40):
        a, b = r.integers(0, 5800, 2)
        flat[a : a + 120] = flat[b : b + 120]
    start = r.permutation(6000 - length)[:3000]
    at, group = equal_groups(flat, start, length)
    got = {}
    for i, g in zip(at.tolist(), group.tolist(), strict=True):
        got.setdefault(g, set()).add(i)
    want = {}
    for i, s in enumerate(start.tolist()):
        want.setdefault(flat[s : s + length].tobytes(), set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def corpus(seed, n, words):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 9))) for _ in range(words)]
    passages = [" ".join(r.choice(vocabulary) for _ in range(r.randint(5, 40))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [" ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60)))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            parts.append(p if r.random() < 0.5 else p[r.randrange(len(p)) :])
            if r.random() < 0.3:
                parts.append("".join(r.choice(vocabulary) for _ in range(5)))
        text = "".join(parts)
        if rows and r.random() < 0.2:
            text = r.choice(rows)[1]
            k = r.randrange(len(text) + 1)
            text = text[:k] + r.choice(["", "x", "yy"]) + text[k + r.randint(0, 2) :]
        rows.append((i * 3 - 20, text))
    return rows


@pytest.mark.parametrize("seed,words", [(1, 3), (2, 40), (3, 2000)])
def test_random_texts(spark, seed, words, monkeypatch):
    rows = corpus(seed, 150, words)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(suffix_dedup.remove_repeats(docs)) == brute(rows)


def test_odd_rows(spark):
    line = "".join(chr(33 + i) for i in range(60))
    rows = [
        (1, None), (2, ""), (3, line[:50]), (4, line), (5, line[:49]), (6, "a" * 3000), (7, "a" * 120), (8, "ab" * 900),
        (None, line), (9, line[10:]), (10, line[:30] + line[:50] + line), (4, line), (11, line + "tail"), (11, line + "tail"),
        (12, "long text " * 60000), (13, "ü" * 60), (14, "xü" * 60), (-5, "tail " + line[5:]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS chunk", "1 AS kind", "2 AS body")
    got = result(suffix_dedup.remove_repeats(docs.repartition(3)))
    assert got == brute([(i, t if i != 12 else t) for i, t in rows])


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()]
    assert sorted(map(tuple, op2_suffix_dedup(spark, "/root/testdata/sf0.001").collect())) == brute(rows)


def test_slices_of_a_bucket(spark, monkeypatch):
    """Buckets compared slice by slice give the same as at once."""
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 3000)
    rng = random.Random(11)
    passages = ["".join(rng.choice("abcd ") for _ in range(140)) for _ in range(12)]
    rows = [(i, "".join(rng.choice("xyz ") for _ in range(40)) + rng.choice(passages) + rng.choice(passages)) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(suffix_dedup.remove_repeats(df)) == brute(rows)
