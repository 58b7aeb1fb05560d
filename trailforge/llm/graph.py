"""Connected components by alternating large-star and small-star steps, all of them aggregations and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailforge.llm.common import give_back, written
from trailforge.operators.skew import hot_keys, salted_join


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node it is connected with) of every node that has an edge. edges: a, b (longs).

    Each step takes a node's smallest neighbour by a partial aggregation and hands it on by a join; a node with very many
    neighbours is dealt to several parts of that join. The steps end when every node but the roots has one neighbour, its
    root.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = written(now, "edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "least")
        total, unfinished = least.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.expr("m < a and n > 1"))).first()
        if not unfinished:
            break
        # A node's rows in either join are at most its edges.
        hot = hot_keys(least, ("a",), "n", total)
        # Large star: greater neighbours of a node link to the node's minimum.
        turned = now.select(F.col("b").alias("a"), F.col("a").alias("b"))
        large = salted_join(turned, least.select("a", F.least("a", "m").alias("m")), ("a",), hot, F.col("b"))
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: a node and its smaller neighbours link to the smallest of them.
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        after = salted_join(large, small, ("a",), hot, F.col("b")).select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        now = written(after.where("a <> b").distinct(), "edges")
    give_back(now.sparkSession)
    # Roots have only greater neighbours.
    return least.select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
