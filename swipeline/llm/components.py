"""Connected components of a table of links, without any of it on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from swipeline.session import cut_lineage

ROUNDS = 40


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest node around it."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link (u, v); a component is named after
    its smallest node. Two stars alternate until every node points at that one.

    The least neighbours are aggregates and the rest are joins, so a node with very many
    links is combined before the shuffle or split by the skew join.
    """
    state = cut_lineage(edges.where("u <> v").select("u", "v").distinct())
    seen = None
    for _ in range(ROUNDS):
        state = cut_lineage(small_star(large_star(state)).distinct())
        mark = state.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"no fixed point after {ROUNDS} rounds")
    members = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
