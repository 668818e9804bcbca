"""Connected components of a distributed edge list by alternating large-star and small-star steps.

Each step is one minimum per node and one join, so no neighbourhood is ever collected, and a node with very many
neighbours is a skewed join at worst. Every step is written to the shared folder: lost executors cost one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.session import durable


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges ``u, v`` with u > v."""
    near = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    if large:  # every larger neighbour of u goes to the least of u and its neighbours
        moved = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:  # every smaller neighbour of u, and u, go to the least of them
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u > v").distinct()


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """``node, root`` for every node of an edge; ``root`` is the least node of its component."""
    found = durable(
        edges.where(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges"
    )
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
    before = found.agg(F.count(F.lit(1)).alias("n"), total).first()
    while before["n"]:
        found = durable(_stars(_stars(found, True), False), "edges")
        after = found.agg(F.count(F.lit(1)).alias("n"), total).first()
        if after == before:
            break
        before = after
    return found.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        found.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
