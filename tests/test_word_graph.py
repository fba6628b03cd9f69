"""Segmentation by the most probable path, against all paths and against a plain dynamic programme."""

import datetime as dt
import itertools
import math
import random

import pytest

from murmur.operators.joins import literal_table
from murmur.operators.tokens import segment_probable, tokenize_with
from murmur.plans import daily


def lexicon_of(rows):
    out = {}
    for word, freq in rows:
        if freq and freq > 0:
            out[word] = out.get(word, 0.0) + freq
    return out


def cost(word, freq, total):
    return round((math.log(freq[word]) - math.log(total) if word in freq else -math.log(total)) * 1e9)


def all_paths(run, freq):
    """The tokens of the best of all cuts of a short run."""
    total = sum(freq.values()) or 1.0
    best = None
    for marks in itertools.product([0, 1], repeat=len(run) - 1):
        cuts = [0, *(i + 1 for i, m in enumerate(marks) if m), len(run)]
        words = [run[a:b] for a, b in itertools.pairwise(cuts)]
        if any(len(w) > 1 and w not in freq for w in words):
            continue
        key = (sum(cost(w, freq, total) for w in words), [len(w) for w in words])
        if best is None or key > best[0]:
            best = key, words
    return best[1]


def programme(run, freq, longest):
    total = sum(freq.values())
    best, take = [0] * (len(run) + 1), [0] * len(run)
    for i in reversed(range(len(run))):
        options = []
        for n in range(1, min(longest, len(run) - i) + 1):
            w = run[i : i + n]
            if n == 1 or w in freq:
                options.append((cost(w, freq, total) + best[i + n], n))
        best[i], take[i] = max(options)
    out, i = [], 0
    while i < len(run):
        out.append(run[i : i + take[i]])
        i += take[i]
    return out


def tokens_of(spark, texts, rows, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_seq int, content string")
    words = spark.createDataFrame(rows, "word string, freq double")
    got = {}
    for r in segment_probable(docs, words, "doc_seq", **more).collect():
        got.setdefault(r.doc_seq, []).append((r.pos, r.token))
    return [[t for _, t in sorted(got.get(i, []))] for i in range(len(texts))]


def test_all_paths(spark):
    rng = random.Random(5)
    rows = [("".join(rng.choice("甲乙丙") for _ in range(rng.randrange(1, 5))), float(rng.randrange(1, 40))) for _ in range(40)]
    texts = ["".join(rng.choice("甲乙丙丁") for _ in range(rng.randrange(1, 11))) for _ in range(150)]
    assert tokens_of(spark, texts, rows) == [all_paths(t, lexicon_of(rows)) for t in texts]


def test_odd_rows(spark):
    rows = [("自由", 10.0), ("自由", 5.0), ("在", None), ("自", -3.0), (None, 4.0), ("abc", 9.0), ("ABC自由", 9.0), ("由在", 1e-3)]
    texts = ["自由在Abc自由, x1 自", "", None, "...", "在" * 500]
    want = [["自由", "在", "abc", "自由", "x1", "自"], [], [], [], ["在"] * 500]
    assert tokens_of(spark, texts, rows) == want
    assert tokens_of(spark, ["自由 b"], []) == [["自", "由", "b"]]
    assert tokens_of(spark, ["Ab 自由"], rows, lower=False) == [["Ab", "自由"]]


def test_probability_beats_length(spark):
    rows = [("研究", 50.0), ("研究生", 5.0), ("生命", 60.0), ("命", 10.0)]
    assert tokens_of(spark, ["研究生命"], rows) == [["研究", "生命"]]


@pytest.mark.parametrize("limit", [None, 0])
def test_lexicon_of_fifty_thousand_words(spark, monkeypatch, limit):
    """Broadcast or, beyond the limit, joined by a shuffle."""
    from murmur.operators import tokens

    if limit is not None:
        lookup = tokens.small_lookup
        monkeypatch.setattr(tokens, "small_lookup", lambda *a: lookup(*a, limit=limit))
    rng = random.Random(9)
    letters = [chr(0x4E00 + i) for i in range(400)]
    rows = list({"".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 2, 2, 3]))): float(rng.randrange(1, 10**6)) for _ in range(80_000)}.items())
    assert len(rows) > 50_000
    texts = ["".join(rng.choice(letters) for _ in range(300)) for _ in range(30)]
    assert tokens_of(spark, texts, rows) == [programme(t, dict(rows), 3) for t in texts]


def test_jobs_take_a_frequency_lexicon(spark):
    docs = spark.createDataFrame([(1, "研究生命")], "doc_seq int, content string")
    words = literal_table(spark, [("研究", 50), ("研究生", 5), ("生命", 60)], ["word", "freq"])
    assert [r.token for r in tokenize_with(docs, "doc_seq", [], words).orderBy("pos").collect()] == ["研究", "生命"]
    assert [r.token for r in tokenize_with(docs, "doc_seq", [], words.drop("freq")).orderBy("pos").collect()] == ["研究生", "命"]
    value = "struct<`內容`: string, content: string, `發佈日期`: string, `發布時間`: string, date: string>"
    raw = spark.createDataFrame([(1, "https://udn.com/1", (None, "研究生命 研究生命", None, None, "2024-01-02"))], f"doc_seq bigint, key string, value {value}")
    stop = literal_table(spark, [("生命",)], ["word"])
    got = daily.daily_keywords(raw, stop, dt.date(2024, 5, 1), words=words)
    assert [(r.keyword, r.cnt) for r in got.collect()] == [("研究", 2)]
