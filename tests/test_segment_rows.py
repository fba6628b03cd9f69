"""Segmentation makes rows of Han characters only: the other words of a text stay in their document."""

import re

import pytest
from pyspark.sql import functions as F

from murmur.operators.tokens import segment, segment_probable



@pytest.mark.parametrize("cut", [segment, segment_probable])
def test_words_of_other_scripts_are_never_sorted(spark, cut):
    """No shuffled or sorted row of the plan holds a piece: a text's pieces were once rows, sorted three times."""
    docs = spark.createDataFrame([(1, "of the 自由 and 自由自在 x" * 3)], "doc_seq long, content string")
    lexicon = spark.createDataFrame([("自由", 5.0), ("自由自在", 3.0)], "word string, freq double")
    plan = cut(docs, lexicon, "doc_seq")._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert joins and not any(re.search(r"\brun#", line) for line in joins)


@pytest.mark.parametrize("cut", [segment, segment_probable])
def test_places_of_runs(spark, cut):
    texts = {1: "a 自由 b, 自 c自由自在由 d 在在 自由", 2: "no han at all", 3: "", 4: None, 5: "自由", 6: "在", 7: "x 在在在 y自由"}
    docs = spark.createDataFrame(list(texts.items()), "doc_seq long, content string").withColumn("site", F.concat(F.lit("s"), "doc_seq"))
    lexicon = spark.createDataFrame([("自由", 5.0), ("自由自在", 900.0)], "word string, freq double")
    got = {}
    for r in cut(docs, lexicon, "doc_seq", carry=["site"]).collect():
        assert r.site == f"s{r.doc_seq}"
        got.setdefault(r.doc_seq, []).append((r.pos, r.token))
    assert {i: " ".join(t for _, t in sorted(x)) for i, x in got.items()} == {
        1: "a 自由 b 自 c 自由自在 由 d 在 在 自由", 2: "no han at all", 5: "自由", 6: "在", 7: "x 在 在 在 y 自由",
    }
    assert all([p for p, _ in sorted(x)] == list(range(len(x))) for x in got.values())
