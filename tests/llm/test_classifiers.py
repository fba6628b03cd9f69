"""Toxicity, quality and language: parts against plain versions, odd inputs, held-out accuracy."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from murmur.llm import langid, quality, toxicity
from murmur.llm.common import fold, labelled_rows, logistic, sigmoid
from murmur.llm.queries import op3_toxicity, op5_quality, op7_language

D = "/root/testdata/sf0.1"
ODD = [(1, None), (2, ""), (3, " \n "), (None, "some text"), (4, "x" * 300_000), (5, "word " * 40_000), (5, "word"), (6, "🙂 12 ?!"), (7, "퟿￿")]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS label", "2 AS hits")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(
    "raw,plain",
    [("You 1D10T!", " you idiot "), ("ѕtuріd", " stupid "), ("m0r0n", " moron "), ("Ídïot", " idiot "), ("l00000ser", " looser "),
     ("in 2024 at 10:30", " in 2024 at 10 30 "), ("", "  "), ("$tupid a$$", " stupid ass ")],
)
def test_folding(raw, plain):
    assert toxicity.fold_text(raw) == plain


def test_finder_equals_plain_search():
    model = toxicity.Model({" idiot ": 2.0, " vequ": 3.0, " the ": 1.0}, (" dear idiot ",), (0.0, 1.0, 0.0), 0.1)
    finder = toxicity.Finder(model)
    text = "Idiot, vequxyz the dear idiot! inveq vequ 1diot idiots"
    words = toxicity.fold_text(text).split()
    hits = [2.0 if w == "idiot" else 3.0 if w.startswith("vequ") else 1.0 if w == "the" else 0 for w in words]
    hits = [h for i, h in enumerate(hits) if h and not (words[i] == "idiot" and i and words[i - 1] == "dear")]
    n, density = finder.find(text)
    assert n == len(hits) and np.isclose(density, sum(hits) / (20 + len(words) + 1) ** 0.5)


def test_logistic_finds_the_rate():
    r = np.random.default_rng(0)
    x = r.standard_normal((5000, 1))
    y = (r.random(5000) < sigmoid(0.5 + 2 * x[:, 0])).astype(int)
    assert np.allclose(logistic(x, y), [0.5, 2], atol=0.2)


def test_sample_does_not_depend_on_partitions(spark):
    docs, given = (spark.read.parquet(f"{D}/{t}.parquet") for t in ("documents", "labels"))

    def rows(d, g):
        return sorted(tuple(r) for r in labelled_rows(d, g, "toxic", F.lit(True), 100).collect())

    a = rows(docs, given)
    assert a == rows(docs.repartition(7), given.repartition(3)) and 100 < len(a) < 300
    whole = {r.doc_id: r.text for r in docs.collect()}
    assert all(whole[i] == t for i, _, t, _ in a) and len({p for *_, p in a}) == 3


def test_sample_of_contradicting_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (3, ""), (None, "d"), (4, "e")], "doc_id long, text string")
    given = labels(spark, [(1, 1, 1), (1, 1, 1), (2, 1, 0), (2, 0, 1), (3, 1, 1), (None, 1, 1), (4, 5, None)])
    assert [tuple(r)[:3] for r in labelled_rows(docs, given, "toxic", F.lit(True), 10).collect()] == [(1, 1, "a")]


def test_lexicon_comes_from_whole_texts(spark):
    """Entries and exceptions that stand far behind the beginning of each text."""
    filler = "plain words of no account " * 1_500  # 39,000 characters before what matters

    def text(i):
        return filler + ("vilestword" if i % 2 else "dear vilestword" if i % 40 == 0 else "gentle")

    rows = [(i, text(i), i % 2) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(5)
    model = toxicity.fit(docs, labels(spark, [(i, y, y) for i, _, y in rows]), F.lit(True))
    assert " dear vilestword " in model.exceptions and any(f.strip() in "vilestword" for f in model.entries)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert min(v for i, v in got.items() if i % 2) > 0.5 > max(v for i, v in got.items() if i % 2 == 0)


def test_counts_equal_plain_ones(spark):
    sample = spark.createDataFrame([(0, " a b "), (1, " b b c "), (1, " c "), (0, "  ")], "label int, folded string").repartition(3)
    got = {r.feature: (r.n0, r.n1) for r in toxicity._counted(sample, lambda x: set(x.split())).collect()}
    assert got == {"a": (1, 0), "b": (1, 1), "c": (0, 2)}


def test_exceptions_cover_as_a_plain_search():
    r = np.random.default_rng(1)
    model = toxicity.Model({" a ": 1.0, " bad": 2.0}, (" b a ", " a b ", " bad c ", " c bad "), (0.0, 1.0, 0.0), 0.1)
    finder = toxicity.Finder(model)
    for _ in range(200):
        words = r.choice(["a", "b", "c", "bad", "badly"], 30).tolist()
        pairs = {("b", "a"), ("a", "b"), ("bad", "c"), ("c", "bad")}
        spared = {j for i in range(29) if (words[i], words[i + 1]) in pairs for j in (i, i + 1)}
        hits = [1.0 if w == "a" else 2.0 for i, w in enumerate(words) if (w == "a" or w.startswith("bad")) and i not in spared]
        n, density = finder.find(" ".join(words))
        assert n == len(hits) and np.isclose(density, sum(hits) / (20 + 31) ** 0.5)


def test_long_disguise():
    assert toxicity.fold_text("antidisestabl1shmentari4ni5m") == " antidisestablishmentarianism "


def test_dictionary_pieces_cover_whole_texts(spark):
    text = "".join(chr(97 + i % 26) for i in range(3 * quality.PIECE + 7))
    rows = spark.createDataFrame([(1, text, 1), (2, "short", 1), (3, "other", 0)], "doc_id long, text string, label int")
    assert b"".join(quality._pieces(rows, 1, 10)) == (text + "short").encode() and quality._pieces(rows, 0, 10) == [b"other"]


def auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable")) + 1
    ones = y.sum()
    return (order[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


@pytest.mark.parametrize("query,label,least", [(op3_toxicity, "toxic", 0.88), (op5_quality, "quality", 0.95)])
def test_held_out_labels(spark, query, label, least):
    got = {r.doc_id: r for r in query(spark, D).collect()}
    assert len(got) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [r for r in pq.read_table(f"{D}/labels.parquet").to_pylist() if got[r["doc_id"]].held_out]
    score, y = np.array([got[r["doc_id"]].score for r in held]), np.array([r[label] for r in held])
    assert auc(score, y) >= least and ((score >= 0.3) == y).mean() >= 0.93


def test_scores_of_odd_rows(spark):
    docs, given = (spark.read.parquet(f"{D}/{t}.parquet") for t in ("documents", "labels"))
    for module, label in ((toxicity, "toxic"), (quality, "quality")):
        model = module.fit(docs, given, F.lit(True), label, 300)
        for m in (model, module.fit(docs, labels(spark), F.lit(True), label)):
            got = module.score(odd(spark), m).collect()
            assert sorted((r.doc_id or 0) for r in got) == sorted((i or 0) for i, _ in ODD)
            assert all(0 <= r.score <= 1 for r in got)
        assert module.score(docs.limit(0), model).collect() == []
        one = labels(spark, [(1, 1, 1), (None, 1, 0), (2, None, None), (1, 1, 1)])
        assert all(0 <= r.score <= 1 for r in module.score(odd(spark), module.fit(docs, one, F.lit(True), label)).collect())


def test_language_probabilities_sum_to_one():
    text = "the cat sat on the mat and the dog ran after the cat"
    g, n = np.unique(langid.grams([text] * 3)[0], return_counts=True)
    model = langid.learn([("en", g, n), ("xx", *np.unique(langid.grams(["zzz yyy xxx"])[0], return_counts=True))])
    letters = model.tables[0][0]
    for context in ("the", " th", "cat"):
        c = np.frombuffer(context.encode("utf-16-le"), np.uint16).astype(np.uint64)
        high = (c[0] << np.uint64(48)) | (c[1] << np.uint64(32)) | (c[2] << np.uint64(16))
        p = np.exp(langid.log_p(model, high | letters)[:, 0].astype(float))
        seen = np.isin(letters, g & np.uint64(0xFFFF))
        assert 0.9 < p[seen].sum() <= 1.001


def test_language_counts_equal_plain_ones(spark):
    rows = [("Ab, c!", "x"), ("ab", "x"), ("", "y"), ("c🙂", "y")]
    got = {(r.lang, r.gram): r.n for r in langid.count(spark.createDataFrame(rows, "text string, lang string").repartition(3)).collect()}
    want = {}
    for t, lang in rows:
        for x in langid.grams([t])[0].view(np.int64).tolist():
            want[lang, x] = want.get((lang, x), 0) + 1
    assert got == want


def test_held_out_language(spark):
    got = {r.doc_id: r for r in op7_language(spark, D).collect()}
    docs = pq.read_table(f"{D}/documents.parquet", columns=["doc_id", "lang"]).to_pylist()
    held = [got[r["doc_id"]].lang_pred == r["lang"] for r in docs if got[r["doc_id"]].held_out]
    assert len(got) == len(docs) and np.mean(held) >= 0.98


def test_language_of_odd_rows(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").limit(300)
    model = langid.fit(docs, fold("doc_id", 3) != 1)
    got = sorted(langid.predict(odd(spark), model).collect(), key=lambda r: (r.doc_id or 0))
    assert len(got) == len(ODD)
    letters = {2: False, 3: False, 1: False, 6: False}
    assert all((r.lang_pred == "und") == (r.doc_id in letters) or r.doc_id == 7 for r in got)
    assert langid.fit(docs.limit(0), F.lit(True)) is None
    assert all(r.lang_pred == "und" and r.score == 0 for r in langid.predict(odd(spark), None).collect())
    assert langid.predict(docs.limit(0), model).collect() == []
