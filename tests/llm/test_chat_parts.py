"""Transcripts: counts made by Spark, and parts of turns that are numbered anyhow."""

import numpy as np
from test_chat import LABELLED

from murmur.llm import chat

KIND = "conv_id long, turn long, role string, line string"


def test_counts_equal_the_plain_ones(spark):
    labelled = [*LABELLED, [("user", "User: a"), ("other", "x"), ("assistant", " "), ("user", "b\n\nc\nd")] * 60]
    rows = [(i, k, role, line) for i, turns in enumerate(labelled) for k, (role, line) in enumerate(turns)]
    want = chat.fit(labelled)
    for size in (64, 3):
        got = chat.fit_parts(chat.in_parts(spark.createDataFrame(rows, KIND).repartition(5), size))
        assert np.allclose(got.start, want.start) and np.allclose(got.move, want.move)
        assert all(np.allclose(a, b) for a, b in zip(got.emit, want.emit, strict=True))
    none = chat.fit_parts(chat.in_parts(spark.createDataFrame([], KIND), 64))
    assert np.allclose(none.move, chat.fit([]).move)


def test_parts_are_bounded_by_rows(spark):
    rows = [(1, None, "user", f"n{i:03d}") for i in range(150)] + [(1, 7, "user", f"s{i:03d}") for i in range(150)]
    rows += [(1, i, "user", f"t{i}") for i in (-1, 0, 3, 500)] + [(None, 1, "user", "lost")] * 200 + [(2, i, "user", "x") for i in range(130)]
    got = chat.in_parts(spark.createDataFrame(rows, KIND).repartition(7), 64).collect()
    assert {r.conv_id for r in got} == {1, 2} and len(got) == 434
    one = [r for r in sorted(got, key=lambda r: r.place) if r.conv_id == 1]
    assert [r.place for r in one] == list(range(304)) and all(r.part == r.place // 64 for r in got)
    want = [r for r in rows if r[0] == 1]
    want.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[3]))
    assert [r.line for r in one] == [r[3] for r in want]
