"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.batches import Scratch

_MAX_ROUNDS = 60


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.join(_least(both), "u").where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are hung on the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    hung = down.join(_least(down), "u")
    return (
        hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(hung.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v): each node of ``edges`` (u, v of any ordered type) that is not the least of its component, and that least.

    Each step is a partial aggregate and a join; a hot node's neighbours are never gathered in
    one task.  The rounds grow with the logarithm of the longest path.  Empty input gives no rows.
    """
    current = scratch.keep(edges.where("u <> v").distinct())
    mark = _mark(current)
    for _ in range(_MAX_ROUNDS):
        following = scratch.keep(_small_star(_large_star(current)))
        new = _mark(following)
        scratch.remove(current)
        current = following
        if new == mark:
            return current
        mark = new
    raise RuntimeError("components did not settle")
