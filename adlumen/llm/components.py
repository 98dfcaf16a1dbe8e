"""Connected components of a graph that no single task can hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adlumen.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b) long pairs; root is the smallest node it reaches.

    Alternates two steps until nothing changes: each node hands its larger neighbours to
    its smallest neighbour, then its smaller ones. Every step keeps the components and ends
    in stars around their smallest nodes after a number of rounds that grows with the
    logarithm of the node count. Minima are combined before the shuffle and joined back,
    so that a node with very many neighbours is never held whole. Each round is written
    to the shared folder.
    """
    now = stored(edges.where("a <> b").selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct(), "edges")
    before = None
    while True:
        size, total = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if before == (size, total):
            return now.selectExpr("b AS node", "a AS root").union(
                now.selectExpr("a AS node", "a AS root").distinct())
        before = (size, total)
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").selectExpr("m AS a", "b").where("a <> b").distinct())
        # now the edges point from the smaller node a to the larger node b
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(least, "b").where("a <> m").selectExpr("m AS a", "a AS b")
                 .union(least.selectExpr("m AS a", "b")).distinct())
        now = stored(small, "edges")
