"""A node whose classes are one component already joins nothing: later trees drop it before its rows are looked up."""

from pyspark.sql import functions as F

from murmur.llm import chosen_path


def classes(spark, n):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words[: i % 60], f"x{i}", *words[i % 60 + 1 :]])) for i in range(n)]
    marks = chosen_path.sketches(spark.createDataFrame(rows, "doc_id long, text string"), 3)
    return marks.select(F.col("doc_id").alias("rep"), "sketch").persist()


def test_nodes_of_one_component_are_dropped(spark):
    found = classes(spark, 150)
    apart = chosen_path.leaves(found.withColumn("comp", F.col("rep")), trees=4, leaf=20, since=2)
    assert {r.tree for r in apart.select("tree").distinct().collect()} <= {2, 3} and apart.count() > 150
    joined = found.withColumn("comp", F.lit(0).cast("long"))
    assert chosen_path.leaves(joined, trees=4, leaf=20, since=2).count() == 0
    # one class outside: only the nodes that it is in stay, each whole
    mixed = chosen_path.leaves(found.withColumn("comp", F.when(F.col("rep") == 7, 7).otherwise(0).cast("long")), trees=4, leaf=20, since=2)
    nodes = mixed.groupBy("node").agg(F.max((F.col("rep") == 7).cast("int")).alias("has"), F.count("*").alias("n"), F.first("size").alias("size"))
    got = nodes.collect()
    assert got and all(r.has == 1 and r.n == r.size for r in got)
