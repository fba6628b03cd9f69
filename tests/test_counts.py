"""Counting within arrays, and the jobs that no longer make a row of every word."""

import collections

from pyspark.sql import functions as F

from murmur.checks import streams
from murmur.functions.counts import occurrences, with_counts
from murmur.operators import annotate as ann
from murmur.operators.layout import SPREAD_BYTES, spread

WORDS = [["b", "a", "b", None, "c", "b", None], [], ["x"], None]


def test_occurrences(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(WORDS)], "i int, w array<string>")
    got = {r.i: r.o for r in df.select("i", occurrences(F.col("w")).alias("o")).collect()}
    assert got[3] is None
    assert [dict(map(tuple, got[i])) for i in range(3)] == [dict(collections.Counter(w)) for w in WORDS[:3]]


def test_with_counts_keeps_order(spark):
    pairs = [("b", "2"), ("a", "1"), ("b", "3"), ("a", "1"), ("b", "2")]
    df = spark.createDataFrame([(1, pairs), (2, [])], "i int, p array<struct<name: string, tag: string>>")
    got = {r.i: [tuple(x) for x in r.o] for r in df.select("i", with_counts(F.col("p")).alias("o")).collect()}
    assert got == {1: [(0, "b", "2", 3), (1, "a", "1", 2), (2, "b", "3", 3), (3, "a", "1", 2), (4, "b", "2", 3)], 2: []}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_annotated_content_makes_no_row_of_a_word(spark):
    kind = "url string, publish_date date, title string, author string, content string, words array<string>, pos array<string>, entities array<struct<entity: string, type: string>>"
    rows = [("u", None, "t", "a", "c", ["x", "y", "x"], ["1", "2", "3"], [("E", "P"), ("E", "Q")]), ("u", None, "t", "a", "c", ["x"], ["1"], None), ("v", None, "t", "a", "c", [], [], None)]
    out = ann.annotated_content(spark.createDataFrame(rows, kind), None, "s")
    assert "Generate" not in plan(out) and "Window" not in plan(out)
    (r,) = out.collect()
    assert r.url == "u" and sorted(map(tuple, r.data.word_pos_frequency)) == [("x", "1", 3), ("x", "1", 3), ("x", "3", 3), ("y", "2", 1)]
    assert [(x.entity, x.type, x.counts) for x in r.data.named_entities] == [("E", "P", 2), ("E", "Q", 2)]


def test_spread_grows_with_the_files(spark, monkeypatch):
    from murmur.operators import layout

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    few = spread(docs, "doc_id").rdd.getNumPartitions()
    monkeypatch.setattr(layout, "SPREAD_BYTES", SPREAD_BYTES >> 11)
    assert spread(docs, "doc_id").rdd.getNumPartitions() > few


def test_stream_files_grow_with_the_tables(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert streams._stream(spark, docs, "few")[1] == {"maxFilesPerTrigger": "2"}
    monkeypatch.setattr(streams, "PART_BYTES", 1 << 17)
    path, files = streams._stream(spark, docs, "more")
    n = spark.read.parquet(path).rdd.getNumPartitions()
    assert len(spark.read.parquet(path).inputFiles()) > 4 and int(files["maxFilesPerTrigger"]) > 2 and n


def test_pack_evaluates_once(spark):
    from murmur.checks.registry import QUERIES

    out = QUERIES["pack_word_pos"](spark, "/root/testdata/sf0.001")
    # a filter on the packed text was moved below and had its own copy of it
    assert out._jdf.queryExecution().optimizedPlan().toString().count("zip_with") == 1
