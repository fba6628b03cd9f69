"""Names of several words in documents."""

import random

import pytest
from pyspark.sql import functions as F

from murmur.operators import annotate as ann

NAMES = [
    ("york", "GPE"), ("new york", "GPE"), ("new  york times", "ORG"), ("york times square", "FAC"),
    ("times", "ORG"), ("new york", "LOC"), (" ", "X"), ("a a", "P"), ("a a a b", "Q"), ("b", "R"),
]


def by_hand(words, names):
    """Places, names and types from left to right, the longest name first."""
    table = {}
    for word, kind in names:
        if word.split():
            table.setdefault(tuple(word.split()), set()).add(kind)
    out, i = [], 0
    while i < len(words):
        n = next((n for n in range(len(words) - i, 0, -1) if tuple(words[i : i + n]) in table), 0)
        out += [(i, " ".join(words[i : i + n]), kind) for kind in sorted(table[tuple(words[i : i + n])])] if n else []
        i += n or 1
    return out


def found(spark, texts, names):
    docs = spark.createDataFrame(
        [(i, t, "x") for i, t in enumerate(texts)], "doc int, words array<string>, type string"
    )
    gazetteer = spark.createDataFrame(names, "word string, type string")
    got = ann.gazetteer_entities(docs, gazetteer, ["doc"]).orderBy("doc", "pos", "type").collect()
    return [[(r.pos, r.entity, r.type) for r in got if r.doc == i] for i in range(len(texts))]


TEXTS = [
    ["in", "new", "york"], ["new", "york", "times", "square"], ["york", "times", "square", "new"], [], ["new"],
    ["new", None, "york"], ["a", "a", "a", "a", "b"], ["a"] * 7 + ["b"], None,
]


def test_leftmost_longest(spark):
    got = found(spark, TEXTS, NAMES)
    assert got == [by_hand(t or [], NAMES) for t in TEXTS]
    assert got[0] == [(1, "new york", "GPE"), (1, "new york", "LOC")]
    assert got[1] == [(0, "new york times", "ORG")]
    assert got[3] == got[4] == got[8] == []


def test_single_words_and_an_empty_gazetteer(spark):
    assert found(spark, TEXTS, [("york", "GPE")])[0] == [(2, "york", "GPE")]
    assert found(spark, TEXTS, []) == [[] for _ in TEXTS]


@pytest.mark.parametrize("limit", [None, 0])
def test_random_names(spark, limit, monkeypatch):
    if limit is not None:  # no broadcast: names of any number
        monkeypatch.setattr(ann, "small_lookup", lambda a, b, k: ann_lookup(a, b, k, limit=limit))
    r = random.Random(5)
    names = sorted({(" ".join(r.choices("abc", k=r.randint(1, 5))), r.choice("XY")) for _ in range(60)})
    texts = [r.choices("abcd", k=r.randint(0, 80)) for _ in range(40)]
    assert found(spark, texts, names) == [by_hand(t, names) for t in texts]


def ann_lookup(a, b, keys, limit):
    from murmur.operators.joins import small_lookup

    return small_lookup(a, b, keys, limit=limit)


def test_no_words_are_shuffled_before_a_match(spark):
    docs = spark.range(10).select("id", F.array(F.lit("new"), F.lit("york")).alias("words"))
    names = spark.createDataFrame([("york", "GPE")], "word string, type string")
    plan = ann.gazetteer_entities(docs, names, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
