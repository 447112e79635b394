"""Connected components of an undirected graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (long columns ``a``, ``b``); the root is the
    least node that can be reached.

    Alternates the large-star and small-star steps of Kiveris et al. (2014): every node hands its
    larger, then its smaller neighbours to the least node it knows. Each step keeps the components
    and at most as many edges as before; all that is grouped is a minimum, so a node with very
    many neighbours is summed up before the shuffle. Steps are stored, and end when a round changes
    nothing.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while (mark := checksum(now)) != before:
        before = mark
        now = stored(small_star(stored(large_star(now))))
    # Every edge now joins a node to its root.
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def checksum(edges: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def large_star(edges: DataFrame) -> DataFrame:
    """Edges (larger, smaller). Every larger neighbour goes to the least of a node and its neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("v"))
    return larger.join(least, "a").select(F.col("v").alias("a"), F.col("least").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour, and the node itself, goes to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return least.select("a", F.col("least").alias("b")).unionAll(moved).distinct()
