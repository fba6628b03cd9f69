"""Connected components of links, by alternating stars.

Each round ties every node to the smallest node among its neighbours: first the larger neighbours
(large star), then the smaller ones (small star). Both are an aggregate that reduces before its
shuffle and a join that may be split where a node has very many links. Rounds are stored in
the shared folder; their number grows with the logarithm of the largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import discard, store


def _ended(links: DataFrame) -> bool:
    """Whether all are stars: no larger end has two smaller ones or is itself a smaller one."""
    ends = links.select(F.col("a").alias("x"), F.lit(1).alias("up")).unionByName(links.select(F.col("b").alias("x"), F.lit(0).alias("up")))
    odd = ends.groupBy("x").agg(F.sum("up").alias("up"), F.min("up").alias("least")).where("up > 1 OR (up = 1 AND least = 0)")
    return not odd.agg(F.count("*")).first()[0]


def components(links: DataFrame) -> DataFrame:
    """(a, b): every node of the links but a component's smallest, with this smallest node.

    ``links`` has columns a and b; direction, repeats and loops don't matter, links with a null are none.
    """
    now = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = store(now, "links")
    while not _ended(now):
        # large star: the larger neighbours of a node move to its smallest one
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its smaller neighbours move to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last, now = now, store(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        discard(last)
    return now
