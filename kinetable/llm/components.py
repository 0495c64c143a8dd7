"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import StageArea


def _least(links: DataFrame) -> DataFrame:
    """Each node's least neighbour; combined before the shuffle, so hubs are no hot keys."""
    return links.groupBy("u").agg(F.min("v").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked with the node's least neighbour or itself."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_least(both), "u").where(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("u"), F.least("least", "u").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are linked with the least of them."""
    least = _least(links)
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select("u", F.col("least").alias("v"))).where(F.col("u") > F.col("v"))


def components(links: DataFrame, stage: StageArea, name: str) -> DataFrame:
    """``(node, root)`` for every node with a link; the root is the least node reachable.

    ``links`` has the columns ``a`` and ``b``, of any ordered type, without nulls; loops
    and repeated links do no harm.  Every round is written to the stage area, so that
    lost executors cost a round at most.  The number of rounds grows with the logarithm
    of the number of nodes.
    """
    links = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    current = stage.table(links.distinct(), f"{name}-links-0")
    before, turn = None, 0
    while True:
        turn += 1
        star = _small_star(_large_star(current).distinct()).distinct()
        current = stage.table(star, f"{name}-links-{turn}")
        mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        state = current.agg(F.count("*"), mark).first()
        if state == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
