"""Alignment of two tokenizers against brute force."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from murmur.llm import align
from murmur.llm.queries import op13_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def bytes_of_letters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def brute(rows):
    t, sp, back = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), bytes_of_letters()
    t.encode_special_tokens = True

    def piece(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    docs, counts = [], collections.Counter()
    for doc_id, text in rows:
        a, b = [], []
        if text:
            a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        raw_a, raw_b = [bytes(back[c] for c in t.id_to_token(i)) for i in a], [piece(i) for i in b]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            a, b, raw_a, raw_b = [], [], [], []
        ends_a, ends_b = (np.cumsum([len(x) for x in raw]).tolist() for raw in (raw_a, raw_b))
        groups, links, i, j = [], [], 0, 0
        for c in sorted(set(ends_a) & set(ends_b)):
            k, m = ends_a.index(c) + 1, ends_b.index(c) + 1
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            links.append((a[k - 1], b[m - 1]))
            i, j = k, m
        counts.update(links)
        docs.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = collections.defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(
        ((d, na, nb, ng, len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), h) for d, na, nb, ng, x, h in docs), key=repr
    )


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ROWS = [
    (1, "Hello world, hello tokens."), (2, None), (3, ""), (4, " "), (5, "  two  spaces\n\n\tand tabs "), (6, "naïve café 数据 🙂 ﬁ"),
    (7, "<|endoftext|> and </s> <s> <unk>"), (None, "Hello world"), (7, "repeated id"), (8, "a" * 5000), (9, "▁ a real one"), (10, "nul \x00 byte"),
    (11, "Hello world, hello tokens."), (12, " " * 3000 + "x"), (13, "word " * 20_000), (14, "antidisestablishmentarianism unhappily"),
]


def test_odd_rows(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3).withColumn("a", F.lit("x")).withColumn("piece", F.lit("y"))
    assert result(align.alignment(df, A, B)) == brute(ROWS)


def test_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(align, "PIECE_BYTES", 200)
    monkeypatch.setattr(align, "BYTES_AT_ONCE", 50)
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(2)
    assert result(align.alignment(df, A, B)) == brute(ROWS)


def test_tables_without_tokens(spark):
    assert align.alignment(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert result(align.alignment(df, A, B)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), unique=True), st.lists(st.integers(1, 30), unique=True))
def test_jumps_reach_the_end_of_the_component(a, b):
    a, b = (np.array(sorted({*x, 31})) for x in (a, b))
    common = [e for e in a if e in b]
    ends = np.concatenate([a, b])
    got = ends[align.terminals(a, b)]
    assert got.tolist() == [min(c for c in common if c >= e) for e in ends]


def test_slow_and_fast_tokenizer_agree():
    first = align.First(A)
    assert first.fast is not None
    for _, text in ROWS:
        if text:
            assert first.encode(text) == first.slow.encode(text, add_special_tokens=False).ids


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    t = pq.read_table(f"{sf}/documents.parquet").to_pydict()
    assert result(op13_alignment(spark, sf)) == brute(list(zip(t["doc_id"], t["text"], strict=True)))
