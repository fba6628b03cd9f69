"""BPE against the public library, word by word and over tables."""

import hashlib

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from murmur.llm import bpe
from murmur.llm.queries import op6_bpe

PATH = P.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)

TEXTS = [
    "", " ", "\n\n  x", "Hello world", "it's we'll I'D 'tis", "aaaaaaaaaaaaa aaaa", "abababab banana bandana",
    "números 12345 ½ ²", "日本語テキスト 中文", "🙂🙂 family 👨‍👩‍👧", "tab\tand\x0b\x0c vertical", " nbsp　wide",
    "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "\x1c\x1d x", "é combining",
    "x" * 5000, "trailing   ", "!!??...---***", "\0\0 nul",
]


def ids_of(items):
    return [x.tolist() for x in bpe.encoder(PATH).encode(items)]


def test_encode_equals_library():
    assert ids_of(TEXTS) == [LIBRARY.encode(t, add_special_tokens=False).ids for t in TEXTS]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text(items):
    if items:
        assert ids_of(items) == [LIBRARY.encode(t, add_special_tokens=False).ids for t in items]


def test_merges_make_tokens_of_their_own():
    v = bpe.vocabulary(PATH)
    assert len(set(v.made.tolist())) == len(v.made)


def test_tables(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5]), (None, "no id"), (100, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "'x' AS lang")
    tokens = bpe.encode(docs, PATH)
    got = sorted(map(tuple, bpe.decode(tokens, PATH).collect()), key=repr)
    want = []
    for i, t in rows:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, LIBRARY.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=repr)
    assert sorted(map(tuple, bpe.round_trip(docs, PATH).collect()), key=repr) == sorted(want, key=repr)


def test_decode_of_any_ids(spark):
    rows = [(1, [220, 50256, 300]), (2, [130, 131]), (3, None), (4, []), (5, [10**6, -1, None, 64])]
    got = {r.doc_id: r.text for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()}
    for i in (1, 2):
        assert got[i] == LIBRARY.decode(rows[i - 1][1], skip_special_tokens=False)
    assert (got[3], got[4], got[5]) == ("", "", "a")


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, PATH), PATH).collect() == []


@pytest.mark.parametrize("size", ["sf0.001"])
def test_query(spark, size):
    import pyarrow.parquet as pq

    d = f"/root/testdata/{size}"
    got = {r.doc_id: tuple(r)[1:] for r in op6_bpe(spark, d).collect()}
    docs = pq.read_table(f"{d}/documents.parquet").to_pylist()
    assert len(got) == len(docs)
    for r in docs:
        ids = LIBRARY.encode(r["text"], add_special_tokens=False).ids
        back = LIBRARY.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back)]
        assert got[r["doc_id"]] == (len(ids), *sha)
