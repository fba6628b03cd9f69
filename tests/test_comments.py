import datetime as dt
import random

from pyspark.sql import functions as F

from murmur.operators import comments as com
from murmur.plans.annotation import stamp_comments
from murmur.schema import COMMENT, DCARD_ZH, PTT_ZH


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def test_explode_struct(spark):
    posts = spark.createDataFrame(
        [("10/24", "題", "未知", "文", 1, 0, 0, "u1", [("推", "a", "好", "t"), ("推", "a", "好", "t")]),
         ("1/2", "題", "b", "文", 0, 0, 0, "u2", [])], PTT_ZH)
    got = rows(com.explode_comments(posts, "留言", url="連結"))
    assert got == [("u1", 0, None, "推", "a", "好", "t"), ("u1", 1, None, "推", "a", "好", "t")]


def test_explode_maps(spark):
    floors = [
        {"B1": {"用戶": "a", "內容": "hi\n\n--", "時間": None}},
        {"B2": {"用戶": "b", "內容": "-----", "時間": "t2"}},
        {"B3": {"用戶": "c", "內容": "x", "時間": "t3"}},
    ]
    posts = spark.createDataFrame([("1", "a", "t", "u", "2024", "c", "0", [], floors, [], "b")], DCARD_ZH)
    posts = posts.withColumn("publish_date", F.lit("2024-01-02"))
    got = rows(com.explode_comment_maps(posts, "留言", url="連結"), "pos", "comment_id", "user", "content", "time")
    assert got == [(0, "B1", "a", "hi", "2024-01-02"), (2, "B3", "c", "x", "t3")]


def thread(spark, n, url="hot"):
    return spark.range(n).select(
        F.lit(url).alias("url"), F.col("id").alias("pos"), F.lit(None).cast("string").alias("comment_id"),
        F.lit("推").alias("tag"), F.lit("u").alias("user"), F.col("id").cast("string").alias("content"),
        F.lit("t").alias("time"),
    )


def test_long_threads_are_nested_in_chunks(spark):
    articles = spark.createDataFrame([("hot", "a"), ("none", "b")], "url string, title string")
    nested = com.nest_comments(thread(spark, 25), articles, True, chunk=10).orderBy("url", "chunk_no").collect()
    assert [(r["url"], r["chunk_no"], len(r["comments"]), r["title"]) for r in nested] == [
        ("hot", 0, 10, "a"), ("hot", 1, 10, "a"), ("hot", 2, 5, "a"), ("none", 0, 0, "b"),
    ]
    assert [c["pos"] for r in nested for c in r["comments"]] == list(range(25))
    assert com.nest_comments(thread(spark, 25), articles, False, chunk=10).count() == 3


def test_gaps_leave_no_empty_chunks(spark):
    articles = spark.createDataFrame([("hot", "a")], "url string, title string")
    gappy = thread(spark, 40).filter("pos < 10 or pos >= 30")
    got = com.nest_comments(gappy, articles, True, chunk=10)
    assert rows(got, "chunk_no", F.size("comments")) == [(0, 10), (3, 10)]


def test_merge_random(spark):
    rng = random.Random(11)

    def crawl(n):
        return [(u, p, None, rng.choice(["推", None]), "a", rng.choice("xyz"), rng.choice(["t", None]))
                for u in ("u1", "u2", "hot") for p in range(n if u != "hot" else 4 * n)]

    old, new = crawl(3), crawl(6) + [("new", 0, None, "推", "a", "x", "t"), ("new", 1, None, "推", "a", "x", "t")]
    want = {}
    for r in old:
        want.setdefault(r[0], []).append(r[3:])
    known = {u: list(v) for u, v in want.items()}
    for r in new:
        if r[3:] not in known.get(r[0], []):
            want.setdefault(r[0], []).append(r[3:])
    merged = com.merge_comments(spark.createDataFrame(old, COMMENT), spark.createDataFrame(new, COMMENT))
    got = {}
    for r in merged.orderBy("url", "pos").collect():
        got.setdefault(r["url"], []).append(tuple(r)[3:])
    assert got == want
    assert merged.select("url", "pos").distinct().count() == merged.count()


def test_push_counts_stop_at_the_first_bad_one(spark):
    tags = ["推", "噓", "→", "推", None, "推", "噓"]
    data = [("u", i, None, t, "a", "c", "t") for i, t in enumerate(tags)] + [("v", 0, None, "噓", "a", "c", "t")]
    assert rows(com.push_counts(spark.createDataFrame(data, COMMENT))) == [("u", 2, 1, 1), ("v", 0, 1, 0)]


def test_push_counts_of_posts_without_counted_comments(spark):
    data = [("u", 0, None, None, "a", "c", "t"), ("u", 1, None, "推", "a", "c", "t")]
    posts = spark.createDataFrame([("u",), ("v",), ("v",)], "url string")
    assert rows(com.push_counts(spark.createDataFrame(data, COMMENT), posts)) == [("u", 0, 0, 0), ("v", 0, 0, 0)]


def test_merge_numbers_what_is_new_only(spark):
    old = spark.createDataFrame([("u", i, None, "推", "a", str(i), "t") for i in range(20)], COMMENT)
    for k in range(3):
        crawl = old.select("url", "pos", "comment_id", "tag", "user", "content", "time")
        new = crawl.unionByName(spark.createDataFrame([("u", 500, None, "推", "a", f"new {k}", "t")], COMMENT))
        old = spark.createDataFrame(com.merge_comments(old, new).collect(), COMMENT)
    assert sorted(r.pos for r in old.collect()) == list(range(23))


def test_long_thread_keeps_all_its_documents(spark):
    thread = spark.range(25).selectExpr("'u' AS url", "id AS pos", "'x' AS content")
    nested = com.nest_comments(thread, spark.createDataFrame([("u", "t")], "url string, title string"), True, chunk=10)
    docs = com.thread_envelope(nested, "ptt").collect()
    assert sorted((d.url, d.chunk_no, d.data.chunks, len(d.data.comments)) for d in docs) == [("u", 0, 3, 10), ("u", 1, 3, 10), ("u", 2, 3, 5)]


def test_emoji_popup(column):
    got = column(com.emoji_map, ["愛心\n12\n哈\nmany", "a\n1\na\n2", "odd", "", None])
    assert got == [{"愛心": "12", "哈": "many"}, {"a": "2"}, {}, {}, None]
    assert column(com.emoji_total, ["12", "many", None]) == [12, 0, 0]


def test_stamp(spark):
    data = [("u", 0, None, "推", "a", "x", "1.2.3.4 10/24"), ("u", 1, None, "推", "a", "--", "t"), ("u", 2, None, "推", "a", "y", "t")]
    df = spark.createDataFrame(data, COMMENT).withColumn("publish_date", F.lit(dt.date(2024, 1, 2)))
    assert rows(stamp_comments(df), "pos", "ip", "date") == [(0, "1.2.3.4", "2024-10-24"), (2, None, "2024-01-02")]
    assert rows(stamp_comments(df, day=None), "pos", "date") == [(0, "2024-10-24"), (2, None)]


def test_emoji_counts(spark):
    df = spark.createDataFrame([("u", [{"愛心": "12", "哈": "many"}]), ("v", [])], "url string, emoji_type array<map<string,string>>")
    assert rows(com.emoji_counts(df)) == [("u", "哈", None), ("u", "愛心", 12)]
