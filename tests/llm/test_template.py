"""Decontamination: template windows, slots and whole tables."""

import re

import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from murmur.llm import template
from murmur.llm.queries import op4_decontamination


def shown(text):
    owner, slot, _, value = template.tokens([text])
    return slot.tolist()


def test_slots():
    N, U, M = template.NUMBER, template.UNIT, template.NAME
    assert shown("Then Anna Smith paid 1,234.50 dollars to Bob") == [0, M, 0, N, U, 0, M]
    assert shown("a 5kg bag, 30 % of $7 and km") == [0, N, U, 0, N, U, 0, U, N, 0, 0]
    assert shown("He left. Then She came") == [0, 0, 0, M, 0]
    assert shown("NATO met in PARIS") == [0, 0, 0, 0]
    assert shown("") == [] and shown("%%% *** ...") == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_texts_don_t_touch(items):
    owner, slot, t, v = template.tokens(items)
    alone = [template.tokens([x]) for x in items]
    assert owner.tolist() == [i for i, a in enumerate(alone) for _ in a[0]]
    for k, got in ((1, slot), (2, t), (3, v)):
        assert got.tolist() == [x for a in alone for x in a[k].tolist()]


ITEM = "Yesterday a farmer named Anna sold 12 apples and then Anna sold 30 pears to her old friend Bob for 7 dollars in all"
ROWS = [
    (1, "Some words before. " + ITEM + ". Some words after"),
    (2, "Here we go. " + ITEM.replace("Anna", "Clara").replace("12", "55").replace("30", "8").replace("Bob", "Dirk")),
    (3, ITEM.replace("then Anna", "then Clara")),  # one value of the item stands for two, all other words are verbatim
    (4, "Yesterday a farmer named Anna sold 12 apples and left the town for good without a word"),
    (5, None),
    (6, ""),
    (7, "clean text " * 3000),
    (8, "x " * 5000 + ITEM.upper()),
    (None, ITEM),
    (9, "a b c d e"),
    (1, "the row again"),
]


def test_items(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "'x' AS found", "1 AS item_id", "2 AS share")
    items = [(10, ITEM), (11, None), (12, "one two"), (13, "a b c d e"), (14, ITEM), (None, ITEM)]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id")
    got = {r.doc_id: (r.contaminated, r.items, r.verbatim) for r in template.contaminated(docs, bench).collect()}
    assert got[1] == (True, [10], True)
    assert got[2] == (True, [10], False)
    assert got[9] == (True, [13], True)
    assert got[3] == (True, [10], True) and got[8] == (True, [10], True)
    assert all(not got[i][0] for i in (4, 5, 6, 7))
    assert template.contaminated(docs, bench).count() == 10


def test_large_benchmark_takes_the_join(spark, monkeypatch):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    bench = spark.createDataFrame([(10, ITEM), (13, "a b c d e")], "item_id long, text string")
    key = lambda df: sorted((r.doc_id, r.contaminated, r["items"]) for r in df.collect())
    want = key(template.contaminated(docs, bench))
    monkeypatch.setattr(template, "FILTER_ROWS", 3)
    assert key(template.contaminated(docs, bench)) == want


def test_empty_tables(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in template.contaminated(docs, none).collect())
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert template.contaminated(empty, spark.createDataFrame([(1, ITEM)], "item_id long, text string")).collect() == []


def test_query(spark):
    """Documents that hold more than half of an item's words in windows of eight."""
    d = "/root/testdata/sf0.01"
    words = lambda t: re.findall(r"\w+", t.lower())
    where, sizes = {}, {}
    for r in pq.read_table(f"{d}/benchmark.parquet").to_pylist():
        w = words(r["text"])
        sizes[r["item_id"]] = len(w)
        for k in range(len(w) - 7):
            where.setdefault(tuple(w[k : k + 8]), []).append((r["item_id"], k))
    want = {}
    for r in pq.read_table(f"{d}/documents.parquet").to_pylist():
        w, found = words(r["text"]), {}
        for k in range(len(w) - 7):
            for i, p in where.get(tuple(w[k : k + 8]), []):
                found.setdefault(i, set()).update(range(p, p + 8))
        want[r["doc_id"]] = sorted(i for i, p in found.items() if len(p) >= sizes[i] / 2)
    got = {r.doc_id: list(r["items"]) for r in op4_decontamination(spark, d).collect()}
    assert got == want
