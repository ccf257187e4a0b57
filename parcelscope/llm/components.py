"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round is two joins against per-node minima, summed with partial aggregation, so that a hub's
edges are never gathered in one task; each round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelscope.llm.common import staged

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = both.filter("v > u").join(least, "u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the least of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (u, v); root is the least node reachable.

    Loops, repeated and reversed edges are fine; edges with a null end are left out.
    """
    current = (
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    current = staged(current, "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        state = current.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if state["n"] == 0 or (state["n"], state["h"]) == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = (state["n"], state["h"])
        current = staged(_small_star(_large_star(current).distinct()).distinct(), "edges")
    raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
