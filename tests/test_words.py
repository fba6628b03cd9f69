import datetime as dt
import heapq
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from murmur.functions import text
from murmur.functions.fixed import POLARITY
from murmur.operators import annotate as ann
from murmur.operators import emotion, keywords, tokens
from murmur.operators.joins import literal_table
from murmur.plans import daily
from murmur.plans.annotation import annotate_threads
from murmur.schema import COMMENT


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def longest_match(s, words):
    out, i = [], 0
    while i < len(s):
        hit = next((w for w in sorted(words, key=len, reverse=True) if len(w) > 1 and s.startswith(w, i)), s[i])
        out.append(hit)
        i += len(hit)
    return out


def test_segment_agrees_with_pattern_and_brute_force(spark):
    rng = random.Random(2)
    words = ["自由", "自由自在", "由自", "在天", "天天向上", "上天"]
    docs = [(i, "".join(rng.choices("自由在天向上", k=rng.randint(0, 30)))) for i in range(200)]
    docs += [(1000, "自由 abc 自由自在。天"), (1001, ""), (1002, "abc")]
    df = spark.createDataFrame(docs, "doc int, content string")
    lexicon = literal_table(spark, [(w,) for w in words], ["word"])
    got = rows(tokens.segment(df, lexicon, "doc", 4))
    assert got == rows(tokens.tokenize(df, ["doc"], words=words))
    by_doc = defaultdict(list)
    for doc, pos, token in sorted(got):
        by_doc[doc].append(token)
    for doc, s in docs[:200]:
        assert by_doc[doc] == longest_match(s, words)


def token_table(spark, docs):
    data = [(d, dt.date(2024, 1, 1 + d % 2), "PTT", p, t) for d, ts in docs for p, t in enumerate(ts)]
    return spark.createDataFrame(data, "doc_seq bigint, publish_date date, source string, pos int, token string")


def test_top_keywords_with_first_seen_ties(spark):
    rng = random.Random(4)
    docs = [(d, rng.choices(["a", "b", "c", "d", " e", "...", "stop", "​"], k=20)) for d in range(12)]
    want = []
    counts = defaultdict(Counter)
    for d, ts in docs:
        for t in ts:
            s = t.strip()
            if s and s != "stop" and any(c.isalnum() for c in s):
                counts[1 + d % 2][t] += 1
    for day, c in counts.items():
        for rank, (w, n) in enumerate(heapq.nlargest(3, c.items(), key=lambda x: x[1]), 1):
            want.append((day, rank, w, n))
    stop = literal_table(spark, [("stop",)], ["word"])
    c = keywords.keyword_counts(token_table(spark, docs), first_seen=("doc_seq", "pos"))
    got = keywords.top_keywords(keywords.valid_keywords(c, stop), 3, tie="first_seen")
    assert rows(got, F.dayofmonth("publish_date"), "rank", "keyword", "cnt") == sorted(want, key=repr)


LEX = [("讚", "喜悅", 1), ("爛", "生氣", 2), ("慘", "失望", 3), ("讚", "支持", 4), ("哇", "驚訝", 5)]


def emotions_of(ts):
    lex, pol = {w: c for w, c, _ in LEX}, dict(POLARITY)
    words, cats = {}, {}
    for t in ts:
        if t in lex:
            words[t] = words.get(t, 0) + 1
            cats[lex[t]] = cats.get(lex[t], 0) + 1
    best = max(cats.items(), key=lambda x: x[1])[0] if cats else None
    return words, best, sum(n * pol[c] for c, n in cats.items())


def test_emotions_against_a_loop(spark):
    rng = random.Random(9)
    docs = [(d, rng.choices(["讚", "爛", "慘", "哇", "字"], k=rng.randint(0, 9))) for d in range(40)]
    toks = token_table(spark, docs)
    lex, pol = literal_table(spark, LEX, ["word", "category", "seq"]), emotion.polarity_table(spark)
    ids = spark.createDataFrame([(d,) for d, _ in docs], "doc_seq bigint")
    got = {r[0]: (r[1], r[2]) for r in emotion.doc_emotions(ids, toks, lex, pol, "doc_seq").collect()}
    assert got == {d: emotions_of(ts)[1:] for d, ts in docs}
    empty = ids.join(toks, "doc_seq", "left").select("doc_seq", "pos", "token")
    once = {r[0]: (r[1], r[2]) for r in emotion.emotions_per_document(empty, lex, pol, ["doc_seq"]).collect()}
    assert once == got
    polar = {r[0]: r[1] for r in emotion.sentiment_score(ids, toks, lex, pol, "doc_seq").collect()}
    assert {r[0]: r[1] for r in emotion.sentiment_per_document(empty, lex, pol, ["doc_seq"]).collect()} == polar
    taken, want = set(), []
    for d, ts in docs:
        words, best, score = emotions_of(ts)
        for rank, (w, n) in enumerate(sorted(words.items(), key=lambda x: (-x[1], x[0]))[:15], 1):
            if (d % 2, rank) not in taken:
                taken.add((d % 2, rank))
                want.append((1 + d % 2, rank, w, n, best, score))
    table = emotion.daily_emotions(toks, lex, pol)
    cols = (F.dayofmonth("publish_date"), "rank", "emotion_word", "cnt", "dominant_emotion", "emotion_score")
    assert rows(table, *cols) == sorted(want, key=repr)


def test_unrated_category_drops_the_document(spark):
    toks = token_table(spark, [(0, ["讚", "爛"]), (2, ["爛"])])
    lex = literal_table(spark, [("讚", "nameless", 1), ("爛", "生氣", 2)], ["word", "category", "seq"])
    pol = emotion.polarity_table(spark)
    ids = spark.createDataFrame([(0,), (2,), (4,)], "doc_seq bigint")
    assert rows(emotion.doc_emotions(ids, toks, lex, pol, "doc_seq")) == [(2, "生氣", -1), (4, None, 0)]
    assert rows(emotion.daily_emotions(toks, lex, pol), "emotion_word") == [("爛",)]
    assert rows(emotion.uncovered(lex, pol)) == [("nameless",)]


def test_lexicon_beyond_broadcast_gives_the_same(spark, monkeypatch):
    from murmur.operators import joins

    toks = token_table(spark, [(d, ["讚", "爛", "讚"]) for d in range(5)])
    lex = literal_table(spark, LEX, ["word", "category", "seq"])
    want = rows(emotion.with_category(toks, lex))
    unknown = spark.createDataFrame([tuple(r) for r in LEX], "word string, category string, seq int")
    assert joins.estimated_bytes(unknown) > joins.BROADCAST_BYTES
    assert rows(emotion.with_category(toks, unknown)) == want


def documents(spark):
    value = "struct<`內容`: string, content: string, `發佈日期`: string, `發布時間`: string, date: string>"
    data = [
        (1, "https://www.ptt.cc/1", ("讚 讚 爛", None, "1/2", None, None)),
        (2, "https://www.dcard.tw/2", ("爛", None, None, "2024-01-02T10:00:00.000Z", None)),
        (3, "https://udn.com/3", (None, "讚", None, None, "2024-01-02 10:00:00")),
        (4, "https://udn.com/4", ("讚", None, None, None, "2024-01-02")),
        (5, "https://udn.com/5", (None, "讚", None, None, "x")),
        (6, None, (None, "讚", None, None, "2024-01-02")),
        (7, "https://www.ptt.cc/7", ("", "", "1/2", None, None)),
    ]
    return spark.createDataFrame(data, f"doc_seq bigint, key string, value {value}")


def test_jobs_read_documents_their_own_way(spark):
    day = dt.date(2024, 1, 2)
    stop = literal_table(spark, [("爛",)], ["word"])
    got = rows(daily.daily_keywords(documents(spark), stop, dt.date(2024, 5, 1)))
    # The keyword job takes either content field, any key and today for a bad date.
    assert got == [
        (day, "PTT", 1, "讚", 2),
        (day, "其他新聞網", 1, "讚", 1),
        (day, "聯合新聞網", 1, "讚", 2),
        (dt.date(2024, 5, 1), "聯合新聞網", 1, "讚", 1),
    ]
    lex = literal_table(spark, LEX, ["word", "category", "seq"])
    got = rows(daily.daily_emotions(documents(spark), lex, emotion.polarity_table(spark)))
    assert got == [
        (day, "Dcard", 1, "爛", 1, "生氣", -1),
        (day, "PTT", 1, "讚", 2, "支持", 1),
        (day, "PTT", 2, "爛", 1, "支持", 1),
        (day, "聯合新聞網", 1, "讚", 1, "支持", 1),
    ]


def test_padding(spark):
    toks = token_table(spark, [(0, ["a", "a", "b"])])
    counts = keywords.keyword_counts(toks)
    got = keywords.top_keywords_padded(counts, dt.date(2024, 1, 1), "PTT", 4)
    assert rows(got) == [(1, "a", 2), (2, "b", 1), (3, None, None), (4, None, None)]


ANNOTATED = "url string, publish_date date, words array<string>, pos array<string>, entities array<struct<entity: string, type: string>>"


def test_annotation_tables(spark):
    day = dt.date(2024, 1, 2)
    df = spark.createDataFrame(
        [("u", day, ["a", "b", "a"], ["Na", "VC", "Nb"], [("台北", "GPE"), ("台北", "ORG"), ("王", "PERSON")]),
         ("v", day, [], [], [])], ANNOTATED)
    assert rows(ann.word_pos_frequency(df)) == [("u", 0, "a", "Na", 2), ("u", 1, "b", "VC", 1), ("u", 2, "a", "Nb", 2)]
    assert rows(ann.entity_mentions(df)) == [
        ("u", 0, "台北", "GPE", 2, day), ("u", 1, "台北", "ORG", 2, day), ("u", 2, "王", "PERSON", 1, day),
    ]
    assert rows(ann.pos_filter(df, ["Na"]), "url", "words", "pos")[0] == ("u", ["b", "a"], ["VC", "Nb"])
    assert rows(tokens.word_frequency_map(df, "url")) == [("u", {"a": 2, "b": 1})]
    articles = df.select("url", "publish_date", F.lit("t").alias("title"), F.lit("a").alias("author"), F.lit("c").alias("content"))
    docs = ann.annotated_content(articles, df.drop("publish_date"), "ptt")
    data = docs.filter("url = 'u'").first()["data"]
    assert [tuple(w) for w in data["word_pos_frequency"]] == [("a", "Na", 2), ("b", "VC", 1), ("a", "Nb", 2)]
    assert [e["counts"] for e in data["named_entities"]] == [2, 2, 1]


def test_threads_are_annotated_once(spark):
    def blank_annotator():
        return lambda texts: [(t.split(), ["Na"] * len(t.split()), [(t.split()[0], "X")]) for t in texts]

    posts = spark.createDataFrame([("u", "a b"), ("v", "c"), ("w", "--")], "url string, content string")
    comments = spark.createDataFrame(
        [("u", 0, None, "推", "x", "d e", "t"), ("u", 1, None, "推", "x", "  ", "t"), ("v", 0, None, "推", "x", "f", "t")], COMMENT
    )
    done = spark.createDataFrame([("v",)], "url string")
    got = annotate_threads(posts, comments, done, blank_annotator)
    assert rows(got, "kind", "url", "pos", "words") == [("comment", "u", 0, ["d", "e"]), ("post", "u", None, ["a", "b"])]


@pytest.mark.parametrize("lower", [True, False])
def test_token_positions(spark, lower):
    df = spark.createDataFrame([(1, "A b, C")], "doc int, content string")
    got = rows(tokens.tokenize(df, ["doc"], lower=lower))
    assert [t if lower else t.lower() for _, _, t in got] == ["a", "b", "c"]
    assert [p for _, p, _ in got] == [0, 1, 2]
    assert text.token_pattern(["自", "自由"]).startswith("自由|自|")


def _longest_match(content, words, longest):
    out, i = [], 0
    while i < len(content):
        for n in range(min(longest, len(content) - i), 0, -1):
            if n == 1 or content[i : i + n] in words:
                out.append(content[i : i + n])
                i += n
                break
    return out


@pytest.mark.parametrize("size", [764, 50_000])
def test_daily_keywords_with_a_lexicon_of_any_size(spark, size):
    r = random.Random(size)
    letters = [chr(0x4E00 + i) for i in range(60 if size < 1000 else 400)]
    words = set()
    while len(words) < size:
        words.add("".join(r.choice(letters) for _ in range(r.randint(2, 4))))
    texts = ["".join(r.choice([r.choice(sorted(words)[:300]), r.choice(letters)]) for _ in range(60)) for _ in range(8)]
    value = "struct<`內容`: string, `發佈日期`: string, `標題`: string, `作者`: string>"
    docs = spark.createDataFrame(
        [(i, f"https://www.ptt.cc/bbs/b/M.{i}.html", (t, "1/2", "t", "a")) for i, t in enumerate(texts)],
        f"doc_seq bigint, key string, value {value}",
    )
    want = Counter(w for t in texts for w in _longest_match(t, words, 4))
    stop = literal_table(spark, [("無",)], ["word"])
    lexicon = spark.createDataFrame([(w,) for w in words], "word string")
    counts = {}
    for given in (lexicon, sorted(words)) if size < 1000 else (lexicon,):
        got = daily.daily_keywords(docs, stop, dt.date(2024, 1, 31), given, k=10**6)
        counts = {x.keyword: x.cnt for x in got.collect()}
        assert counts == dict(want)


def test_keywords_keep_their_case_if_asked(spark):
    value = "struct<`內容`: string, `發佈日期`: string, `標題`: string, `作者`: string>"
    docs = spark.createDataFrame(
        [(1, "https://www.ptt.cc/bbs/b/M.1.html", ("NATO Nato nato", "1/2", "t", "a"))], f"doc_seq bigint, key string, value {value}"
    )
    stop = literal_table(spark, [("x",)], ["word"])
    for lower, want in ((True, {"nato": 3}), (False, {"NATO": 1, "Nato": 1, "nato": 1})):
        got = daily.daily_keywords(docs, stop, dt.date(2024, 1, 31), lower=lower)
        assert {r.keyword: r.cnt for r in got.collect()} == want
