import random

import pytest
from pyspark.sql import functions as F

from murmur.operators import ingest, tables
from murmur.operators.joins import literal_table, salted_lookup, small_lookup
from murmur.streaming.ingest import ORDER


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_decode_takes_an_empty_key_for_none(spark):
    raw = spark.createDataFrame(
        [("t", 0, 1, b"", "{}".encode()), ("t", 0, 2, None, None), ("t", 0, 3, "鍵".encode(), "值".encode())],
        "topic string, partition int, offset bigint, key binary, value binary",
    )
    assert [tuple(r)[3:5] for r in ingest.decode(raw).orderBy("offset").collect()] == [
        (None, "{}"), (None, None), ("鍵", "值"),
    ]


def test_what_counts_as_json(spark):
    values = ['{"n":1,"n":2}', '{"n":NaN}', '{"n":1} x', '{"n":1}}', '{"n":1', "", None, "[]", "3", '{"n":"many"}', '{"n":1},{"n":2}']
    raw = spark.createDataFrame(list(enumerate(values)), "i int, value string")
    good, bad = ingest.parse_messages(raw, "n int")
    assert {r.i: r.value and r.value.n for r in good.collect()} == {0: 2, 1: None, 7: None, 8: None, 9: None}
    assert sorted(r.i for r in bad.collect()) == [2, 3, 4, 5, 6, 10]


def test_keyless_messages_by_arrival(spark):
    import datetime as dt

    raw = [("t", p, o, None, "{}", dt.datetime(2024, 1, 1, 0, m)) for p, o, m in ((3, 1, 1), (0, 900, 9), (1, 5, 4))]
    rows_ = spark.createDataFrame(raw, "topic string, partition int, offset bigint, key string, value string, timestamp timestamp")
    assert ingest.latest_by_key(rows_, ["key"], ORDER).first().offset == 900


def test_parse_messages(spark):
    raw = spark.createDataFrame(
        [(1, '{"a": 1}'), (2, '{"a": '), (3, None), (4, '{"b": 2}'), (5, "x")], "offset int, value string"
    )
    good, bad = ingest.parse_messages(raw, "a int")
    assert rows(good.select("offset", "value.a")) == [(1, 1), (4, None)]
    assert rows(bad.select("offset")) == [(2,), (3,), (5,)]


def test_latest_by_key_random(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.randint(0, 3), i, rng.choice(["x", None])) for i in range(300)]
    want = {}
    for r in sorted(data, key=lambda r: (r[1], r[2])):
        want[r[0]] = r
    df = spark.createDataFrame(data, "key string, partition int, offset int, value string").repartition(4)
    assert rows(ingest.latest_by_key(df, ["key"], ["partition", "offset"])) == sorted(want.values(), key=repr)


def test_messages_keep_nulls_and_han(spark):
    df = spark.createDataFrame([("u", "中文", None)], "url string, title string, reporter string")
    assert rows(ingest.to_messages(df, "url")) == [("u", '{"url":"u","title":"中文","reporter":null}')]


SCHEMA = "day string, rank int, word string, n int"


def test_upsert_keeps_stale_ranks_and_takes_nulls(spark):
    old = spark.createDataFrame([("d1", 1, "a", 5), ("d1", 2, "b", 4)], SCHEMA)
    new = spark.createDataFrame([("d1", 1, "c", None), ("d2", 1, "z", 1)], SCHEMA)
    assert rows(tables.upsert(old, new, ["day", "rank"])) == [("d1", 1, "c", None), ("d1", 2, "b", 4), ("d2", 1, "z", 1)]


def test_insert_ignore_first_writer_wins(spark):
    old = spark.createDataFrame([("a", 1, "old")], "id string, seq int, v string")
    new = spark.createDataFrame([("a", 2, "x"), ("b", 5, "late"), ("b", 3, "first"), ("b", 9, "last")], old.schema)
    assert rows(tables.insert_ignore(old, new, ["id"], ["seq"])) == [("a", 1, "old"), ("b", 3, "first")]


def test_validate(spark):
    df = spark.createDataFrame([("d", "k"), ("d", ""), (None, "k"), ("d", None)], "day string, word string")
    ok, bad = tables.validate(df, ["day", "word"], ["day", "word"], ["word"])
    assert rows(ok) == [("d", "k")] and bad.count() == 3
    with pytest.raises(ValueError, match="rank"):
        tables.validate(df, ["rank"], [])
    assert rows(tables.duplicate_keys(df, ["day"])) == [("d", 3)]


def test_unprocessed_keeps_rows_without_key(spark):
    src = spark.createDataFrame([("a", None), ("b", True), (None, False), ("c", False)], "url string, done boolean")
    done = spark.createDataFrame([("c",), ("c",), (None,)], "url string")
    assert rows(tables.unprocessed(src, done, flag="done").select("url")) == [("a",), (None,)]


def test_union_fills_missing_fields(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, "y")], "id int, b string")
    assert rows(tables.union_sources(a, b)) == [(1, "x", None), (2, None, "y")]


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_lookups_agree(spark, how):
    rng = random.Random(5)
    data = [(rng.choice(["hot"] * 5 + ["a", "b", None]), i % 7) for i in range(500)]
    df = spark.createDataFrame(data, "k string, n int")
    table = literal_table(spark, [("hot", 1), ("b", 2)], ["k", "v"])
    if how in ("left_anti", "left_semi"):
        table = table.select("k")
    plain = rows(df.join(table, ["k"], how))
    assert rows(salted_lookup(df, table, ["k"], how)) == plain
    assert rows(small_lookup(df, table, ["k"], how)) == plain
    # A table beyond the limit takes the salted way.
    assert rows(small_lookup(df, table, ["k"], how, limit=0)) == plain


def test_broadcast_only_within_the_limit(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    table = literal_table(spark, [("1",)], ["k"])

    def plan(limit):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            return small_lookup(df, table, ["k"], limit=limit)._jdf.queryExecution().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    assert "BroadcastHashJoin" in plan(1 << 20)
    assert "BroadcastHashJoin" not in plan(0) and "_salt" in plan(0)
