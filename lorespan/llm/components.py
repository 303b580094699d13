"""Connected components of a link table by alternating large-star and small-star steps.

Only narrow (node, node) rows are shuffled, minima are combined before the shuffle, joins are on one
node and can be split when a hub has very many links. Every round is written to the shared scratch
folder; nothing is gathered on the driver but row counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorespan.session import materialize


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of ``links`` (columns ``a``, ``b``).

    Links to itself and repeated links are allowed; links with a null end are ignored; an empty table
    gives an empty result. ``most_rounds`` guards against an endless loop: the method needs a number of
    rounds that grows with the logarithm of the longest path, and going beyond it is an error.
    """
    edges = (
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    edges, before = materialize(edges, "links"), None
    for _ in range(most_rounds):
        edges = materialize(_small_star(_large_star(edges)), "stars")
        # A fixed point has one edge from every node to its smallest: the sums stop changing.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return stars.unionByName(centres)
        before = tuple(now)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    # Neighbours larger than v are the u of its edges; v's own smallest neighbour is below it or v itself.
    return (
        edges.join(smallest.withColumnRenamed("u", "v"), "v", "left")
        .select("u", F.coalesce("m", "v").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, are linked to the smallest of them."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    kept = smallest.select("u", F.col("m").alias("v"))
    moved = edges.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionByName(moved).distinct()
