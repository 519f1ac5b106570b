"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umitally.llm.common import write_table


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = write_table(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = write_table(down.groupBy("a").agg(F.min("b").alias("m")))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(a, b), a is not b -> (node, root): the least node of each node's component; nodes without edges are absent.

    Each step groups with map-side minima and joins them back. The minima are written first, so that the join reads plain
    shuffles, of which AQE splits the one that holds a node of very many edges. Every round is written too, which cuts
    lineage; the number of rounds grows with the logarithm of the size.
    """
    edges = edges.select("a", "b").where("a <> b")
    for _ in range(most_rounds):
        edges = write_table(_small_star(write_table(_large_star(edges))).where("a <> b").distinct())
        # Done when no node is tied to two others, and none that is tied has others tied to it.
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if not ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1").limit(1).count():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (node, root) of components with more links (a, b) between any nodes: only their roots are worked on."""
    of = lambda x: labels.select(F.col("node").alias(x), F.col("root").alias(f"r{x}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b").distinct()
    between = write_table(between)
    if not between.limit(1).count():
        return labels
    steps = components(between)
    moved = labels.join(steps.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return write_table(moved.unionByName(steps))
