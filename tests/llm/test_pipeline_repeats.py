"""Stage repeated_passages joins what is kept of the texts with the other columns, without the texts themselves."""

import corpus_pipeline as pipe

LONG = "a passage of some length that stands in two texts and is long enough to be found by all means"
SCHEMA = "doc_id long, source string, n_chars int, text string"


def test_columns_and_nulls(spark):
    rows = [(1, "a", 7, LONG), (2, "b", 7, "own " + LONG), (3, "c", 7, LONG), (4, None, None, None), (5, "d", 0, ""), (6, "e", 9, "short é")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, pipe.drop_repeats(spark, docs, "").collect()))
    assert got == [rows[0], (2, "b", 4, "own "), *rows[3:]]


def test_texts_do_not_move(spark):
    docs = spark.createDataFrame([(1, "a", 7, LONG), (2, "b", 7, LONG)], SCHEMA)
    plan = pipe.drop_repeats(spark, docs, "")._jdf.queryExecution().optimizedPlan()
    joins = [plan]
    while joins[-1].nodeName() != "Join":
        joins.append(joins[-1].children().head())
    left = joins[-1].children().head()
    names = [left.output().apply(i).name() for i in range(left.output().size())]
    assert "source" in names and "text" not in names
