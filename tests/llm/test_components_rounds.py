"""Links that are stars already need no round; what a leaf finds comes as stars."""

import pytest

from murmur.llm import chosen_path, components


@pytest.fixture
def stored(monkeypatch):
    names = []
    real = components.store
    monkeypatch.setattr(components, "store", lambda df, name: (names.append(name), real(df, name))[1])
    return names


def test_stars_need_no_round(spark, stored):
    links = spark.createDataFrame([(5, 1), (7, 1), (9, 2), (2, 9), (3, 3)], "a long, b long")
    assert sorted(map(tuple, components.components(links).collect())) == [(5, 1), (7, 1), (9, 2)]
    assert len(stored) == 1


def test_a_chain_ends_at_its_smallest(spark, stored):
    links = spark.createDataFrame([(i, i + 1) for i in range(10, 40)], "a long, b long")
    assert sorted(map(tuple, components.components(links).collect())) == [(i, 10) for i in range(11, 41)]


def test_a_group_gives_stars(spark):
    # each text is near the next one only
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join([*(f"x{k}" for k in range(i * 4)), *words[i * 4 :]])) for i in range(12)]
    marks = chosen_path.sketches(spark.createDataFrame(rows, "doc_id long, text string"), 3)
    full = chosen_path._full(
        spark.createDataFrame(rows, "doc_id long, text string"),
        marks.selectExpr("1L key", "doc_id rep", "n_shingles", "doc_id comp", "sketch", "cast(null as array<long>) done"), 3,
    )
    links = sorted(map(tuple, chosen_path._confirmed(full, 2, 85).collect()))
    assert links == [(i, 0) for i in range(1, 12)]
