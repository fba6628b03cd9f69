"""Nearest neighbours: exact scores, ties, repeated vectors, and recall against brute force."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from murmur.llm import forest
from murmur.llm.queries import op9_neighbours


def brute(ids, x, k, is_query):
    out = {}
    for i in range(len(ids)):
        if is_query(ids[i]):
            s = (x * x[i]).sum(axis=1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
            out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / max(1, len(w)) for q, w in want.items()])


def table(spark, ids, x):
    rows = [(int(i), [float(v) for v in r]) for i, r in zip(ids, x)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


@pytest.mark.parametrize("block", [4096, 64])
def test_all_norms(spark, block):
    r = np.random.default_rng(3)
    x = (r.standard_normal((1200, 16)) * r.uniform(0.2, 3, (1200, 1))).astype(np.float32).astype(float)
    ids = np.arange(1200)
    got = found(forest.nearest(table(spark, ids, x), F.col("vec_id") % 20 == 0, 20, block=block))
    want = brute(ids, x, 20, lambda i: i % 20 == 0)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    exact = {(q, i): s for q, w in brute(ids, x, 1200, lambda i: i % 20 == 0).items() for i, s in w}
    assert all(abs(exact[q, i] - s) < 1e-12 * max(1, abs(s)) for q, w in got.items() for i, s in w)


def test_one_vector_in_a_third_of_all_rows(spark):
    r = np.random.default_rng(4)
    x = r.standard_normal((600, 8)).astype(np.float32).astype(float)
    x[::3] = x[0]
    x[1::30] = x[0] * 2
    ids = np.arange(600)
    got = found(forest.nearest(table(spark, ids, x), F.col("vec_id") % 20 == 0, 20, block=50, share=30.0))
    want = brute(ids, x, 20, lambda i: i % 20 == 0)
    assert {q: [i for i, _ in w] for q, w in got.items()} == {q: [i for i, _ in w] for q, w in want.items()}


def test_odd_rows(spark):
    n = float("nan")
    rows = [
        (0, [1.0, 0.0]), (20, None), (40, []), (60, [0.0, 0.0]), (80, [n, 1.0]), (100, [float("inf"), 1.0]), (None, [1.0, 1.0]),
        (1, [0.5, 0.5]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, None]), (4, [1.0, 2.0, 3.0]), (5, [-1.0, 0.0]), (120, [2.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS rep", "2 AS score", "'x' AS vector")
    got = found(forest.nearest(df, F.col("vec_id") % 20 == 0, 20))
    assert {q: [i for i, _ in w] for q, w in got.items()} == {0: [120, 2, 1, 5], 120: [0, 2, 1, 5]}
    assert got[0][0][1] == 2.0


def test_empty_table(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert forest.nearest(df, F.col("vec_id") % 20 == 0).collect() == []


def test_query(spark):
    d = "/root/testdata/sf0.1"
    t = pq.read_table(f"{d}/embeddings.parquet")
    ids, x = t["vec_id"].to_numpy(), np.stack(t["embedding"].to_numpy()).astype(float)
    want = brute(ids, x, 20, lambda i: i % 20 == 0)
    assert recall(found(op9_neighbours(spark, d)), want) >= 0.9
