"""The trained classifier over all documents."""

import os

import pyarrow.parquet as pq

from murmur.checks import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def test_every_document_is_judged(spark):
    got = {r.doc_id: r for r in QUERIES["sentiment_classifier"](spark, SF).collect()}
    docs = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id"]).to_pydict()["doc_id"]
    assert sorted(got) == sorted(docs)
    assert all(r.predicted in ("positive", "negative") and 0.5 <= r.confidence <= 1 for r in got.values())
    assert {i for i, r in got.items() if r.held_out} == {i for i in docs if i % 5 == 0}
    labels = pq.read_table(f"{SF}/labels.parquet").to_pydict()
    right = [(got[i].predicted == "positive") == (q == 1) for i, q in zip(labels["doc_id"], labels["quality"], strict=True) if i % 5 == 0]
    assert len(right) > 20 and sum(right) / len(right) >= 0.75
