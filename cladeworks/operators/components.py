"""Connected components of an undirected edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeworks.runtime import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of u is tied to the least node of u's neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the least of them; every edge has u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node with an edge; component is its least reachable node.

    The work of a round is linear in the edges and no neighbourhood is gathered in one row. Rounds grow
    with the logarithm of the diameter; ``RuntimeError`` if ``max_rounds`` do not suffice. Self-loops
    count as nodes of their own component; nulls are ignored.
    """
    pairs = materialize(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).dropna())
    loops = pairs.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    current = materialize(pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    for _ in range(max_rounds):
        current = materialize(_small_star(_large_star(current)))
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components not settled in {max_rounds} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    labels = current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
    return labels.unionByName(loops).groupBy("node").agg(F.min("component").alias("component"))
