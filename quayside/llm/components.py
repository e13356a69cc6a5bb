"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.base import stored


def _sum(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; a component is its least node.

    Alternating large and small stars: each round hangs neighbours on the least node known to
    either, until nothing moves; that takes about the logarithm of the longest path. A node's least
    neighbour is a partial aggregate, and the join back is one that adaptive execution splits, so
    a node with very many edges is no hot spot. Each round is stored, which keeps plans short.
    """
    edges = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _sum(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Large star: neighbours beyond a node go to the least node around it.
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # Small star: neighbours before a node, and the node, go to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = stored(small.filter("a <> b").distinct(), "edges")
        after = _sum(edges)
        if after == before:
            break
        before = after
    return edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").union(
        edges.select("b", F.col("b").alias("component")).distinct())
