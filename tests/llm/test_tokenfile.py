"""Token files: round trip, format, damage and access to single documents."""

import zlib

import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from murmur.llm import tokenfile
from murmur.llm.queries import op1_token_files

PATH = P.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    "", "A b", None, "The CAT's <|endoftext|> x <|ENDOFTEXT|>", "ÉCOLE  Straße\tİstanbul ΣΑΣ ΟΔΟΣ", "é ́x",
    " nbsp　wide\x1cfs\x85nel", "日本語 🙂", "word " * 3000, "it's\nwe'll 12 345!!", "\r\n\r\n",
    "a\x01b \x01 c", "\x01", "́x ́ y",
]


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.fixture
def written(spark, tmp_path):
    rows = [(7 * i, t) for i, t in enumerate(TEXTS)] + [(7, "again"), (None, "lost")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS path", "0 AS file")
    return tokenfile.write(docs, f"file://{tmp_path}/out", PATH), tmp_path / "out"


def test_round_trip(written):
    manifest, _ = written
    want, start = [], 0
    rows = sorted([(7 * i, t or "") for i, t in enumerate(TEXTS)] + [(7, "again")])
    for i, t in rows:
        want.append((i, start, ids_of(t)))
        start += len(want[-1][2])
    got = [(r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in tokenfile.read(manifest).collect()]
    assert sorted(got) == sorted(want)


def test_any_decoder_reads_the_file(written):
    manifest, _ = written
    for r in manifest.collect():
        raw = open(r.path.removeprefix("file://"), "rb").read()
        whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        assert len(whole) == 4 * r.tokens


def test_single_documents(spark, written):
    manifest, _ = written
    wanted = spark.createDataFrame([(7,), (21,), (21,), (5,), (None,)], "doc_id long")
    got = sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in tokenfile.fetch(manifest, wanted).collect())
    assert got == sorted([(7, ids_of("A b")), (7, ids_of("again")), (21, ids_of(TEXTS[3]))])


def test_reader_reads_its_frames_only(written):
    manifest, _ = written
    r = max(manifest.collect(), key=lambda r: r.docs)
    reader = tokenfile.Reader(r.path)
    raw = bytearray(open(r.path.removeprefix("file://"), "rb").read())
    raw[int(reader.offsets[0]) + 6 : int(reader.offsets[1])] = b"\xff" * (int(reader.entries["packed"][0]) - 6)
    open(r.path.removeprefix("file://"), "wb").write(raw)
    reader = tokenfile.Reader(r.path)
    if r.docs > 1:
        assert reader.frame(len(reader.doc_ids) - 1)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        reader.frame(0)


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    manifest = tokenfile.write(docs, f"file://{tmp_path}/out", PATH)
    assert tokenfile.read(manifest).collect() == []


def test_query(spark):
    d = "/root/testdata/sf0.001"
    got = sorted(map(tuple, op1_token_files(spark, d).collect()))
    want, start = [], 0
    for r in sorted(pq.read_table(f"{d}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"]):
        ids = ids_of(r["text"])
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abAB's'lve<|>019.,!?&%éÉßÿÀ×ª´µñ́\x01\x1c\t ΣİK", max_size=12), max_size=6))
def test_pieces_as_the_library(items):
    encoder = tokenfile.encoder(PATH, True)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(items)] == [LIBRARY.encode(x, add_special_tokens=False).ids for x in items]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(tokenfile, "MEMORY_BYTES", 1000)
    encoder = tokenfile.Encoder(PATH, True)
    for i in range(200):
        assert np.frombuffer(encoder.encode([f"word{i} again"])[0], "<u4").tolist() == LIBRARY.encode(f"word{i} again", add_special_tokens=False).ids
        assert encoder.held < 4000
    for kind in (dict(type="BertNormalizer"), None):  # of an unknown rule nothing is assumed
        assert tokenfile._steps(kind, "normalizers") == ([kind] if kind else [])
