"""Connected components of a distributed edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriframe.llm.shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or the node)."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    onward = down.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return onward.unionAll(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of the edges ``a, b`` (longs); the root is the smallest node reachable.

    The rounds grow with the logarithm of the longest path; each is written to the
    shared folder. Self links are ignored, no edge gives no row. A node with many
    links is reduced by partial minima before its shuffle and never gathered.
    """
    current = stored(edges.where("a <> b").select("a", "b"), "edges")
    seen = None
    while True:
        current = stored(_small_star(_large_star(current)), "edges")
        state = current.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
