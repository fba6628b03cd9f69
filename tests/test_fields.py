"""Upsert by field: batch, log and random messages; JSON to its end; orders as numbers."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from murmur.operators import ingest
from murmur.schema import MESSAGE
from murmur.sources import io
from murmur.streaming.ingest import ingest_fields_stream, read_fields

SCHEMA = "a bigint, b string, c array<int>"
ORDER = ["timestamp", "partition", "offset"]


def messages(seed, n):
    rng, out = random.Random(seed), []
    for i in range(n):
        value = {k: v for k, v in (("a", i), ("b", None if i % 3 else f"b{i}"), ("c", [i, i])) if rng.random() < 0.4}
        at = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(50)) if rng.random() < 0.9 else None
        text = rng.choice([json.dumps(value)] * 8 + ["[1]", '{"a": NaN}', '{"a": 1, "a": 2}'])
        out.append(("t", rng.randrange(3), i, rng.choice(["hot", "hot", "x", "y", None]), text, at))
    return out


def brute(rows):
    docs = {}
    for topic, part, offset, key, value, at in sorted(rows, key=lambda r: (r[5] is not None, r[5] or dt.datetime.min, r[1], r[2])):
        doc = docs.setdefault(key, {"a": None, "b": None, "c": None})
        doc["place"] = (topic, part, offset)
        given = json.loads(value)
        if isinstance(given, dict):
            doc.update({k: None if v != v else v for k, v in given.items()})
    return sorted(((k, *d["place"], d["a"], d["b"], d["c"]) for k, d in docs.items()), key=repr)


def result(df):
    return sorted(((r.key, r.topic, r.partition, r.offset, r.value.a, r.value.b, r.value.c) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_random_messages(spark, seed):
    rows = messages(seed, 120)
    df = spark.createDataFrame(rows, MESSAGE).repartition(3)
    assert result(ingest.merge_fields_by_key(df, SCHEMA, ["key"], ORDER)) == brute(rows)
    # winners of parts merge to the same, and there are at most four per key and part
    parts = [df.filter(F.col("offset") % 3 == i) for i in range(3)]
    kept = [ingest.field_winners(p, SCHEMA, ["key"], ORDER) for p in parts]
    assert max(r["count"] for k in kept for r in k.groupBy("key").count().collect()) <= 4
    log = kept[0].unionByName(kept[1]).unionByName(kept[2])
    assert result(ingest.merge_fields_by_key(log, SCHEMA, ["key"], ORDER)) == brute(rows)


def test_log_over_restarts(spark, tmp_path):
    path, table, bad, ckpt = (str(tmp_path / n) for n in ("in", "table", "bad", "ckpt"))
    rows = messages(7, 90)
    broken = [("t", 0, 1000 + i, "x", v, None) for i, v in enumerate(('{"a":1}]', "", None))]
    for part in (rows[:30], rows[30:50] + broken, rows[50:]):
        spark.createDataFrame(part, MESSAGE).coalesce(2).write.mode("append").parquet(path)
        source = io.read_messages(spark, "parquet", {"maxFilesPerTrigger": "1"}, path, stream=True)
        ingest_fields_stream(source, SCHEMA, table, bad, ckpt).awaitTermination()
    assert result(read_fields(spark, table, SCHEMA)) == brute(rows)
    assert spark.read.parquet(bad).count() == len(broken)


def test_explicit_null_and_absent(spark):
    rows = [("t", 0, 1, "k", '{"a": 1, "b": "x"}', None), ("t", 0, 2, "k", '{"b": null}', None), ("t", 0, 3, "k", "{}", None)]
    df = spark.createDataFrame(rows, MESSAGE)
    assert result(ingest.merge_fields_by_key(df, SCHEMA, ["key"], ORDER)) == [("k", "t", 0, 3, 1, None, None)]
    assert ingest.merge_fields_by_key(df.filter("offset > 9"), SCHEMA, ["key"], ORDER).collect() == []


def test_json_to_its_end(spark):
    good = ['{"a":1}', '{"a":1} ', "[1]", "null", '"x"', '{"a":NaN}', '{"a":1,"a":2}', '{"a":"]}"}']
    bad = ['{"a":1}]garbage', '{"a":1}]', "1],[2", '1},{"x":2', '{"a":1}}', '{"a":1} x', "1,", "", "  ", None, "tru", '{"a":1']
    df = spark.createDataFrame([("t", 0, i, "k", v, None) for i, v in enumerate(good + bad)], MESSAGE)
    ok, rest = ingest.parse_messages(df, "a string")
    assert sorted(r.offset for r in ok.collect()) == list(range(len(good)))
    assert sorted(r.offset for r in rest.collect()) == list(range(len(good), len(good + bad)))


def test_orders_as_numbers(spark):
    times = [None, dt.datetime(1, 1, 2), dt.datetime(1969, 12, 31), dt.datetime(2024, 1, 1), dt.datetime(9999, 12, 30)]
    rows = [(t, p, o) for t in times for p in (None, 0, 7, 99_000) for o in (None, 0, 5, 10**14)]
    df = spark.createDataFrame(rows, "timestamp timestamp, partition int, offset bigint")
    at = ingest.order_number(df, ORDER)
    got = [tuple(r)[:3] for r in df.withColumn("at", at).orderBy("at").collect()]
    want = [tuple(r) for r in df.orderBy(*(F.col(c).asc_nulls_first() for c in ORDER)).collect()]
    assert got == want and df.select(at).distinct().count() == len(rows)
    with pytest.raises(Exception, match="out of its order's range"):
        spark.createDataFrame([(None, 0, -1)], df.schema).select(ingest.order_number(df, ORDER)).collect()


def test_no_sorting_aggregate(spark):
    df = spark.createDataFrame(messages(1, 10), MESSAGE)
    for out in (ingest.latest_by_key(df, ["key"], ORDER), ingest.merge_fields_by_key(df, SCHEMA, ["key"], ORDER)):
        assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    # a message delivered twice counts once; other orders still work
    twice = df.unionByName(df)
    assert ingest.latest_by_key(twice, ["key"], ORDER).count() == df.select("key").distinct().count()
    assert ingest.latest_by_key(twice, ["key"], ["value"]).count() == df.select("key").distinct().count()
