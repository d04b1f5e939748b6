"""Connected components of links between numbers, as joins and aggregations that work on edges alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.session import store


def _lowest(edges: DataFrame) -> DataFrame:
    """``node, low``: the lowest of each node and its neighbours, of edges in both directions."""
    return store(edges.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("node"), F.least("a", "low").alias("low")
    ), "links-lowest")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b``; the root is the lowest node that links lead to.

    Each round ties all neighbours of a node to the lowest of them. Neighbours are first those above the node, then those
    below; the rounds end when every edge leads to a root, after about the logarithm of the longest path.
    A node with many neighbours is combined before the shuffle, and its edges may be split in the join.
    """
    edges = store(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _lowest(both)
        upper = both.filter("b > a").join(low, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        upper = store(upper.filter("a <> b").distinct(), "links")
        low = _lowest(upper)
        lower = upper.join(low, F.col("a") == F.col("node")).select("b", "low")
        lower = lower.select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").unionByName(
            low.select(F.col("node").alias("a"), F.col("low").alias("b")).filter("a <> b")
        )
        after = store(lower.distinct(), "links")
        # done when each node has one edge, and no node that others lead to leads on
        roots = after.select(F.col("b").alias("a")).distinct()
        if after.count() == after.select("a").distinct().count() and after.join(roots, "a", "left_semi").isEmpty():
            break
        edges = after
    found = after.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return store(found.unionByName(found.select(F.col("root").alias("node"), "root").distinct()), "links-roots")
