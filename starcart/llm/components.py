"""Connected components of a graph given as pairs of node ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starcart.llm.words import stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)``: every node of the edges ``(a, b)`` with the least node it can reach.

    Large-star and small-star steps in turn (Kiveris et al. 2014): each node hands its
    neighbours to the least of them, until the edges are stars around the least nodes. A
    step is a minimum per node, combined before the shuffle, and a join with it; nothing
    is gathered per node. Rounds grow with the logarithm of the longest chain.
    Null ids and loops are left out.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a != b")
        .distinct(),
        "edges",
    )
    before = _checksum(now)
    while before[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        after = _checksum(now)
        if after == before:
            break
        before = after
    roots = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.union(now.select("b", "b").distinct())


def _checksum(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to the least among its neighbours and itself."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
