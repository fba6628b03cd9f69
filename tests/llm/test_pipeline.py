"""The pipeline, stage by stage, against brute force."""

import pyarrow.parquet as pq
import pytest
from test_chosen_path import WORD
from test_suffix_dedup import brute as brute_repeats

import corpus_pipeline as pipe
from murmur.llm import toxicity
from murmur.llm.queries import tokenizer

D = "/root/testdata/sf0.001"


def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def kept_of_groups(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    owner = {i: i for i, _ in sets}

    def root(x):
        while owner[x] != x:
            x = owner[x]
        return x

    for k, (i, s) in enumerate(sets):
        for j, z in sets[:k]:
            common = len(s & z)
            if common and 100 * common >= 80 * (len(s) + len(z) - common):
                a, b = sorted((root(i), root(j)))
                owner[b] = a
    return {i for i in owner if root(i) == i}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{D}/documents.parquet")


def table(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, docs):
    columns = docs.columns
    stages = dict(pipe.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "repeated_passages", "decontamination", "token_ids"]

    clean = stages["toxicity"](spark, docs, D)
    model = toxicity.fit(docs, spark.read.parquet(f"{D}/labels.parquet"), pipe.F.lit(True))
    finder = toxicity.Finder(model)
    rows = table(docs)
    want = {i for i, r in rows.items() if toxicity._scores(finder, model, [r.text])[1][0] < 0.3}
    assert clean.columns == columns and set(table(clean)) == want and len(want) > 150

    once = stages["near_duplicates"](spark, clean, D)
    left = table(once)
    assert once.columns == columns and set(left) == kept_of_groups([(i, rows[i].text) for i in sorted(want)])
    assert all(left[i] == rows[i] for i in left)

    cut = stages["repeated_passages"](spark, once, D)
    got = table(cut)
    plain = {r[0]: r for r in brute_repeats([(i, r.text) for i, r in left.items()])}
    assert cut.columns == columns
    for i, (_, size, removed, _, _) in plain.items():
        if size and removed == size:
            assert i not in got
        elif removed:
            assert len(got[i].text.encode()) <= size - removed and got[i].n_chars == len(got[i].text)
        else:
            assert got[i] == left[i]

    sound = stages["decontamination"](spark, cut, D)
    items = [r["text"].lower() for r in pq.read_table(f"{D}/benchmark.parquet").to_pylist()]
    kept = table(sound)
    assert sound.columns == columns and all(kept[i] == got[i] for i in kept)
    gone = set(got) - set(kept)
    assert gone == {i for i, r in got.items() if any(x in r.text.lower() for x in items)}

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    for i, r in table(stages["token_ids"](spark, sound, D)).items():
        assert r.ids == library.encode(kept[i].text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.text == kept[i].text


def test_run_equals_the_stages(spark, docs):
    part = docs
    for _, stage in pipe.STAGES:
        part = stage(spark, part, D)
    assert sorted(map(str, pipe.run(spark, D).collect())) == sorted(map(str, part.collect()))


def test_odd_rows(spark):
    rows = [(1, None, None, None, 0), (2, "", "en", "s", 0), (None, "no id", "en", "s", 5), (None, "no id", "en", "s", 5),
            (3, "one two three four five six", "en", "s", 27), (4, "one two three four five six", "en", "s", 27), (3, "one two", None, "s", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipe.STAGES[1:4]:
        df = stage(spark, df, D)
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    # rows without an id and rows that share one are rows of their own; of copies one stays
    assert got == sorted([(1, None), (2, ""), (3, "one two"), (3, "one two three four five six"), (None, "no id")], key=repr)
    empty = spark.createDataFrame([], df.schema)
    for _, stage in pipe.STAGES:
        empty = stage(spark, empty, D)
    assert empty.collect() == []
