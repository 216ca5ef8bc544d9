"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradewind.session import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` with the smallest node of each component, for every node of ``edges(a, b)``.

    Alternates large-star and small-star steps until the edges are a star around each smallest node.
    Minima are taken per task before the shuffle, and a hub with very many edges is the skewed side
    of a plain join, so no group is collected. Every step is written to the shared folder.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    while True:
        # Large star: every neighbour above the node goes to the node's smallest neighbour.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: every neighbour below the node, and the node, go to its smallest neighbour.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        # Done when every edge leads to a node that has no smaller neighbour, and no node has two.
        ends = edges.select("a", F.lit(1).alias("n")).unionByName(edges.select(F.col("b").alias("a"), F.lit(0).alias("n")))
        ends = ends.groupBy("a").agg(F.sum("n").alias("up"), F.min("n").alias("is_below"))
        if ends.where("up > 1 OR (up > 0 AND is_below = 0)").isEmpty():
            break
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("label", F.col("node"))
    return stored(edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots))
