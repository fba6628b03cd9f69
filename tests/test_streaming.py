import datetime as dt
import json

from pyspark.sql import functions as F

from murmur.operators import frontier as fr
from murmur.operators import keywords, tokens
from murmur.operators.ingest import latest_by_key, parse_messages
from murmur.operators.joins import literal_table
from murmur.schema import MESSAGE
from murmur.sources import io
from murmur.streaming import daily, enrich, ingest, log

VALUE = "n bigint"


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def message(i):
    key = None if i % 9 == 0 else ["hot", "a", "b"][i % 3]
    return ("t", i % 2, i, key, '{"n": ' if i % 7 == 0 else json.dumps({"n": i}), None)


def feed(spark, path, start, end):
    spark.createDataFrame([message(i) for i in range(start, end)], MESSAGE).coalesce(2).write.mode("append").parquet(path)


def test_ingest_equals_batch_over_restarts(spark, tmp_path):
    path, table, bad, ckpt = (str(tmp_path / n) for n in ("in", "table", "bad", "ckpt"))
    for start, end in ((0, 40), (40, 60), (60, 100)):
        feed(spark, path, start, end)
        source = io.read_messages(spark, "parquet", {"maxFilesPerTrigger": "1"}, path, stream=True)
        ingest.ingest_stream(source, VALUE, table, bad, ckpt).awaitTermination()
    everything = io.read_messages(spark, "parquet", path=path)
    good, rejected = parse_messages(everything, VALUE)
    want = rows(latest_by_key(good, ["key"], ["partition", "offset"]))
    assert rows(ingest.read_collection(spark, table).select(*good.columns)) == want
    assert spark.read.parquet(bad).count() == rejected.count()
    # A batch that runs again leaves the same collection.
    again = spark.read.parquet(table).filter("batch_id = 1").drop("batch_id").collect()
    log.put(spark.createDataFrame(again, good.schema), table, 1)
    assert rows(ingest.read_collection(spark, table).select(*good.columns)) == want
    compacted = str(tmp_path / "compacted")
    log.compact(spark, table, compacted, ["key"], ["partition", "offset"])
    assert spark.read.parquet(compacted).count() == len(want)
    assert rows(ingest.read_collection(spark, compacted).select(*good.columns)) == want


def test_append_keeps_copies(spark, tmp_path):
    path, table = str(tmp_path / "in"), str(tmp_path / "out")
    feed(spark, path, 0, 10)
    feed(spark, path, 0, 10)
    source = io.read_messages(spark, "parquet", path=path, stream=True)
    ingest.append_stream(source, table, str(tmp_path / "ckpt")).awaitTermination()
    assert spark.read.parquet(table).count() == 20


def test_daily_keywords_equal_batch(spark, tmp_path):
    path, table, ckpt = (str(tmp_path / n) for n in ("in", "table", "ckpt"))
    schema = "publish_date date, source string, content string"
    stop = literal_table(spark, [("the",)], ["word"])
    day = dt.date(2024, 1, 1)
    for part in (["the cat sat", "a cat"], ["dog dog dog", "the dog"], ["cat cat cat cat"]):
        spark.createDataFrame([(day, "PTT", t) for t in part], schema).write.mode("append").parquet(path)
        source = spark.readStream.schema(schema).parquet(path)
        daily.daily_keywords_stream(source, table, ckpt).awaitTermination()
    counts = keywords.keyword_counts(tokens.tokenize(spark.read.parquet(path), keywords.GROUP))
    want = keywords.top_keywords(keywords.valid_keywords(counts, stop), 2)
    assert rows(daily.read_daily_keywords(spark, table, stop, 2)) == rows(want)


def test_frontier_equals_batch(spark, tmp_path):
    path, table, ckpt = (str(tmp_path / n) for n in ("in", "table", "ckpt"))
    schema = "url string, seq bigint, kind string, date date"
    day = dt.date(2024, 1, 1)
    events = [(f"u{i % 5}", i, "failed" if i % 11 == 10 else "ok", day + dt.timedelta(i)) for i in range(60)]
    for part in (events[:20], events[20:30], events[30:]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(path)
        source = spark.readStream.schema(schema).parquet(path)
        daily.frontier_stream(source, table, ckpt).awaitTermination()
    want = fr.settle(fr.fold(spark.createDataFrame(events, schema)))
    assert rows(daily.read_frontier(spark, table)) == rows(want)


def test_enrich(spark):
    value = json.dumps({"url": "u", "title": "t", "reporter": None, "content": "台北 cat\n\n\ncat --", "date": "d"})
    gone = json.dumps({"title": "empty"})
    df = spark.createDataFrame(
        [("n", 0, 1, None, "{", None), ("n", 0, 2, "k", gone, None), ("n", 0, 3, "k", value, None), ("n", 0, 4, None, gone, None)], MESSAGE
    )
    names = literal_table(spark, [("cat", "X")], ["word", "type"])
    got = {r["key"]: r for r in enrich.enrich(df, names).collect()}
    assert got["k"]["content"] == "台北 cat\ncat"
    assert got["k"]["word_frequency"] == {"台": 1, "北": 1, "cat": 2}
    assert [tuple(e) for e in got["k"]["entities"]] == [("cat", "X"), ("cat", "X")]
    assert got[None]["content"] == "" and got[None]["entities"] == [] and got[None]["word_frequency"] == {}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01", "a"), (2, "2024-01-02", "b")], "id int, publish_date string, v string")
    table = str(tmp_path / "t")
    io.replace_partitions(df, table)
    io.replace_partitions(df.filter("id = 2").withColumn("v", F.lit("new")), table)
    assert rows(spark.read.parquet(table), "id", "v") == [(1, "a"), (2, "new")]
    io.overwrite(df.filter("id = 1"), str(tmp_path / "o"))
    io.write_messages(df, "id", "json", {}, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 2
    (tmp_path / "posts.json").write_text('[{"id": "1", "title": "題", "content": ""}, {"id": "2", "title": null, "content": "x"}]')
    assert rows(io.read_posts(spark, str(tmp_path / "posts.json"))) == [("1", "題", ""), ("2", None, "x")]
    (tmp_path / "words.txt").write_text("的\n\n了\n")
    assert rows(io.read_words(spark, str(tmp_path / "words.txt"))) == [("了",), ("的",)]
    (tmp_path / "lex.csv").write_text("word,category,seq\n讚,喜悅,1\n")
    assert rows(io.read_lexicon(spark, str(tmp_path / "lex.csv"))) == [("讚", "喜悅", 1)]


def test_documents_of_different_topics_stay_apart(spark):
    from murmur.operators.joins import literal_table
    from murmur.streaming.enrich import enrich

    value = '{"content": "%s"}'
    raw = [("a", 0, 1, "x", value % "dog"), ("b", 0, 1, "y", value % "cat cat"), ("b", 0, 2, "z", value % "")]
    messages = spark.createDataFrame(raw, "topic string, partition int, offset bigint, key string, value string").selectExpr(
        "*", "cast(null as timestamp) AS timestamp"
    )
    names = literal_table(spark, [("dog", "PET"), ("cat", "PET")], ["word", "type"])
    got = {r.key: (r.word_frequency, [tuple(e) for e in r.entities]) for r in enrich(messages, names).collect()}
    assert got == {"x": ({"dog": 1}, [("dog", "PET")]), "y": ({"cat": 2}, [("cat", "PET")] * 2), "z": ({}, [])}


def test_no_state_is_kept(spark, tmp_path):
    schema = "publish_date date, source string, content string"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    run = daily.daily_keywords_stream(source, str(tmp_path / "t"), str(tmp_path / "c"))
    run.awaitTermination()
    assert not (tmp_path / "c" / "state").exists()


def test_compacted_counts(spark, tmp_path):
    rows_ = [(dt.date(2024, 1, 1), "s", "a", 2)]
    for i in (0, 1):
        log.put(spark.createDataFrame(rows_, "publish_date date, source string, keyword string, cnt bigint"), str(tmp_path / "t"), i)
    daily.compact_counts(spark, str(tmp_path / "t"), str(tmp_path / "n"))
    assert [r.cnt for r in daily.running_counts(spark, str(tmp_path / "n")).collect()] == [4]


def test_frontier_after_the_stream(spark, tmp_path):
    first = [("u", 1, "ok", dt.date(2024, 1, 1)), ("v", 2, "ok", dt.date(2024, 1, 2))]
    later = [("u", 3, "failed", dt.date(2024, 1, 3)), ("u", 4, "ok", dt.date(2024, 1, 4)), ("v", 5, "ok", dt.date(2024, 1, 5))]
    schema = "url string, seq bigint, kind string, date date"
    for i, part in enumerate((first, later)):
        log.put(fr.fold(spark.createDataFrame(part, schema)), str(tmp_path / "t"), i)
    seeded = spark.createDataFrame(
        [("1", dt.date(2024, 1, 1), u, 0, 0, None) for u in ("u", "v", "w")],
        "id string, date date, url string, first_crawl int, confirm_num bigint, last_update date",
    )
    want = fr.apply_events(seeded, spark.createDataFrame(first + later, schema))
    assert rows(daily.read_frontier(spark, str(tmp_path / "t"), seeded)) == rows(want)
