"""Connected components by alternating large-star and small-star, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import discard, keep

col = F.col


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest node around it."""
    both = edges.unionByName(edges.select(col("v").alias("u"), col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    return (both.filter(col("v") > col("u")).join(least, "u")
            .select(col("v").alias("u"), F.least("u", "least").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    moved = down.join(least, "u").filter(col("v") != col("least")).select(col("v").alias("u"), col("least").alias("v"))
    return moved.unionByName(least.select("u", col("least").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; the component is its smallest node.

    ``edges`` has two columns of comparable ids; edges with nulls and from a node to itself do not count.
    A node with very many edges is spread by adaptive skew joins; minima are taken before shuffling.
    The number of rounds grows with the logarithm of the longest path. No edges give an empty table.
    """
    a, b = edges.columns
    now = keep(edges.select(col(a).alias("u"), col(b).alias("v"))
               .filter(col("u") != col("v")).distinct())
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("h")).first()
        if state == before or state.n == 0:
            break
        before = state
        wide = keep(_large_star(now).distinct())
        after = keep(_small_star(wide).distinct())
        discard(now, wide)
        now = after
    members = now.select(col("u").alias("node"), col("v").alias("component"))
    return members.unionByName(now.select(col("v").alias("node"), col("v").alias("component")).distinct())
