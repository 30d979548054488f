"""Connected components by alternating large and small stars, one written table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from modelmon.llm.common import fixed


def _lowest(pairs: DataFrame) -> DataFrame:
    """Per node its lowest neighbour. The sums are combined before the shuffle, so a hub costs one row per task."""
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every higher neighbour of a node moves to the lowest of the node and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    return both.join(_lowest(both), "u").where("v > u").select(
        F.least("u", "m").alias("a"), F.col("v").alias("b")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lower neighbours move to the lowest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = _lowest(down)
    moved = down.join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return moved.unionByName(low.select(F.col("m").alias("a"), F.col("u").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge (a, b); root is the lowest node it can reach.

    Each round is written to the shared folder, which cuts the lineage; the loop ends when a round changes nothing.
    No edges: an empty table.
    """
    state = fixed(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        state = fixed(_small_star(_large_star(state)), "stars")
    return state.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        state.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
