"""Connected components of a graph given as edges, by alternating star contraction.

A round points the larger neighbours of every node at its least neighbour, then does the same for the
smaller ones; after some log(nodes) rounds every node points at the least node of its component. Least
neighbours are pre-aggregated sums, so a hub with a third of all edges is never gathered in one row; it
meets its edges again in a plain join, which Spark splits if it is skewed. Each round is written to the
shared folder, so a lost executor costs no earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from saleslake.llm.common import written


def _least(edges: DataFrame) -> DataFrame:
    """For each u of the edges (u, v) its least v."""
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).withColumn("least", F.least("least", "u"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v")))


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, root) of every node of the edges (u, v); root is the least node of its component."""
    clean = "u <> v"
    edges = written(edges.select("u", "v").where(clean).distinct(), f"{purpose}-0")
    state = None
    turn = 0
    while True:
        turn += 1
        edges = _small_star(_large_star(edges)).where(clean).distinct()
        edges = written(edges, f"{purpose}-{turn}")
        now = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(28,0)")).alias("digest"),
        ).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
