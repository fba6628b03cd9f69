"""The pipeline's stages on rows without a doc_id and rows that share one."""

import pyarrow.parquet as pq
import pytest

import corpus_pipeline as pipe

D = "/root/testdata/sf0.001"
SIX = "one two three four five six"
LONG = "a passage of some length that stands in two texts and is long enough to be found by all means"


@pytest.fixture
def stage(spark):
    def run(name, rows):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        out = dict(pipe.STAGES)[name](spark, df, D)
        assert out.columns == df.columns
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)

    return run


def test_copies_without_an_id(stage):
    assert stage("near_duplicates", [(None, SIX)] * 3 + [(None, "other words here")]) == sorted([(None, SIX), (None, "other words here")], key=repr)
    assert stage("near_duplicates", [(None, SIX), (9, SIX), (7, None), (None, None)]) == sorted([(9, SIX), (7, None), (None, None)], key=repr)


def test_rows_that_share_an_id(stage):
    assert stage("near_duplicates", [(3, SIX), (4, SIX), (3, "one two")]) == [(3, SIX), (3, "one two")]  # by repr


def test_passages_of_rows_without_an_id(stage):
    got = stage("repeated_passages", [(None, "first " + LONG), (5, LONG + " last"), (None, ""), (5, "short")])
    assert (5, LONG + " last") in got and (5, "short") in got and (None, "") in got and len(got) == 4
    assert any(i is None and t and len(t) < 20 for i, t in got)


def test_letters_at_a_cut(stage):
    """A letter that a cut would halve goes whole; what stands for unreadable bytes in a text of its own stays."""
    # the repeated bytes end within the first letter after them: both begin with the same byte
    got = dict(stage("repeated_passages", [(1, LONG + "é"), (2, "own \ufffd text " + LONG + "è end")]))
    assert got[2] == "own \ufffd text  end"


def test_benchmark_texts_without_an_id(stage):
    item = pq.read_table(f"{D}/benchmark.parquet").to_pylist()[0]["text"]
    assert stage("decontamination", [(None, item), (1, "clean"), (1, item), (None, "clean too")]) == sorted([(1, "clean"), (None, "clean too")], key=repr)
