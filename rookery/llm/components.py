"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm.tables import staged


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """node, component (the smallest node reachable) of every node that has a link.

    ``links`` has the long columns a and b, in either order.  Large-star and
    small-star rounds (each node hands its larger neighbours to the smallest
    one, then its smaller ones) end in stars; the rounds grow with the
    logarithm of a chain's length.  A node's smallest neighbour is an aggregate and goes
    back by an equality join, so a hub is split like any skewed join, never gathered.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = staged(links.select(low.alias("a"), high.alias("b")).filter("a < b").distinct(), "links")
    for _ in range(max_rounds):
        if _all_stars(edges):
            break
        # a is a smaller neighbour of b; both directions for the large star.
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = (
            both.filter("b > a")
            .join(least.withColumnRenamed("a", "node"), F.col("a") == F.col("node"))
            .select(F.col("least").alias("a"), "b")
        )
        large = staged(large, "large-star")
        least = large.groupBy("b").agg(F.min("a").alias("least")).withColumnRenamed("b", "node")
        small = large.join(least, F.col("b") == F.col("node"))
        edges = (
            small.select("least", F.col("a").alias("other"))
            .union(small.select("least", F.col("b").alias("other")))
            .filter("least < other")
            .select(F.col("least").alias("a"), F.col("other").alias("b"))
            .distinct()
        )
        edges = staged(edges, "small-star")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    leaves = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    centres = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return leaves.union(centres)


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or the leaf of one centre."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("leaf")).union(edges.select("b", F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("leaf").alias("leaves"), F.min("leaf").alias("least"))
    odd = nodes.filter((F.col("leaves") > 1) | ((F.col("leaves") == 1) & (F.col("least") == 0)))
    return odd.agg(F.count(F.lit(1))).first()[0] == 0
