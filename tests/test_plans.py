"""What the plans must and must not contain."""

import pytest

from murmur.checks import QUERIES
from murmur.session import scratch, shared_dir

SF = "/root/testdata/sf0.001"
PYTHON = ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "MapInArrow")


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().toString()


STREAMS = {n for n in QUERIES if n.startswith("stream_")}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS - {"annotate", "sentiment_classifier"}))
def test_native_and_without_cross_joins(spark, name):
    text = plan(spark, name)
    assert not any(p in text for p in PYTHON)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_keywords_are_cut_before_the_last_shuffle(spark):
    physical = plan(spark, "daily_keywords_top15").split("== Physical Plan ==")[1]
    # Read from the sink: final limit, exchange, partial limit, word tests, aggregate.
    order = [physical.index(s) for s in ("Final", "Exchange hashpartitioning(publish_date", "Partial", "LeftAnti", "partial_count")]
    assert order == sorted(order)
    assert physical.index("RLIKE") < physical.index("partial_count")


@pytest.mark.parametrize("name", ["word_pos_frequency", "entity_mentions"])
def test_documents_move_once_for_all_windows(spark, name):
    physical = plan(spark, name).split("== Physical Plan ==")[1]
    assert "ENSURE_REQUIREMENTS" not in physical


def test_scan_reads_only_what_is_needed(spark):
    physical = plan(spark, "frontier_seed").split("== Physical Plan ==")[1]
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp" in physical
    assert "props" not in physical and "EqualTo(event_type,signup)" in physical


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x").startswith(shared_dir(spark) + "/x-")


def test_new_comments_can_be_split_by_adaptive_execution(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        physical = plan(spark, "new_comment_difference").split("== Physical Plan ==")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Join, sort and exchange on either side, with no aggregate between them.
    assert physical.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" in physical and "HashAggregate" not in physical
