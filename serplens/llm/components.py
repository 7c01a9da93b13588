"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from serplens.sources.storage import let_go, materialize, release


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(both: DataFrame, around: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node under the smallest of its surroundings; edges may repeat."""
    return both.where("b > a").join(around, "a").select(F.col("b").alias("a"), F.least("a", "least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours under the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    # The smallest neighbour's own row is the one that hangs the node itself.
    return edges.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                         F.col("m").alias("b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b: bigint), label the smallest node reachable.

    Every step is written to the shared folder, so plans stay short. The driver sees one
    count per round; the number of rounds grows with the logarithm of the longest
    path, and links that are stars already take none. Self links and null ends are
    ignored; no links give no rows.
    """
    edges = materialize(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    while True:
        both, seen = _both_ways(edges), Observation()
        around = materialize(
            both.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("n")).observe(
                seen, F.expr("count_if(n > 1 AND least < a)").alias("unsettled")),
            "surroundings")
        # Where no node has both a smaller neighbour and another one, all components are stars around their smallest.
        if not seen.get.get("unsettled"):
            release(edges)
            return around.select(F.col("a").alias("node"), F.least("a", "least").alias("label"))
        large = materialize(_large_star(both, around), "large_star")
        release(edges, around)
        edges = materialize(_small_star(large), "components")
        release(large)
        let_go(edges.sparkSession)
