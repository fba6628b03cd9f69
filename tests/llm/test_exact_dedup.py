"""Exact duplicates against brute force, with wide and with narrow fingerprints."""

import hashlib
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from murmur.llm import exact_dedup
from murmur.llm.exact_dedup import exact_duplicates
from murmur.llm.queries import op11_exact_dedup


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        taken = False
        for i in ids:
            kept = i == keep and not taken
            taken |= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in df.collect()), key=repr)


ROWS = [
    (1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (6, "long " * 300_000), (7, "long " * 300_000), (8, "A"), (9, "a "),
    (10, "数"), (10, "数"), (None, "a"), (None, "null alone"), (None, "null alone"), (11, "unique"), (-(2**63), "low"), (-(2**63), "low"),
]


@pytest.mark.parametrize("bits", [64, 6, 3])
def test_odd_rows(spark, bits):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    df = df.withColumn("digest", F.lit("x")).withColumn("piece", F.lit(1)).withColumn("body", F.lit("y"))
    assert result(exact_duplicates(df, bits=bits)) == brute(ROWS)


def test_random_rows_in_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "ROWS_IN_PIECE", 40)
    monkeypatch.setattr(exact_dedup, "FRAME_BYTES", 20)
    monkeypatch.setattr(exact_dedup, "TEXT_AT_ONCE", 50)
    rng = random.Random(3)
    rows = [(i, "hot" if rng.random() < 0.4 else f"t{rng.randrange(150)}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(exact_duplicates(df)) == brute(rows)
    assert result(exact_duplicates(df, bits=5)) == brute(rows)


def test_empty_table_and_normalised_texts(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert exact_duplicates(none).collect() == []
    df = spark.createDataFrame([(1, "A b"), (2, "a B")], "doc_id long, text string")
    assert [r.keep_id for r in exact_duplicates(df, normalise=F.lower).collect()] == [2, 2]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted((tuple(r) for r in op11_exact_dedup(spark, sf).collect()), key=repr)
    t = pq.read_table(f"{sf}/documents.parquet").to_pydict()
    assert got == brute(list(zip(t["doc_id"], t["text"], strict=True)))
