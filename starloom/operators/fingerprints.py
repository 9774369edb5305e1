"""Reconciling two copies of a table by a tree of multiset fingerprints.

A row's fingerprint is two hashes of all its columns; those of a set of rows are added up, with their number, so the order
of rows doesn't matter and repeated rows count.  Leaves are runs of ``LEAF`` keys, a node sums ``FANOUT``
nodes below it.  The tree of a table is small and is stored once; two trees are compared from the root down,
below a node only where it differs, and rows are read only in the key ranges of leaves that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import stored

LEAF_BITS = 6
FANOUT_BITS = 6
RANGES = 200  # more ranges than that are read by a join on the leaf


def _marks(columns: Sequence[str]) -> list[Column]:
    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns], *[F.col(f"`{c}`").isNull() for c in columns]).cast("decimal(38,0)"))

    return [F.count(F.lit(1)).alias("rows"), total(1).alias("h1"), total(2).alias("h2")]


def tree(df: DataFrame, key: str) -> DataFrame:
    """(level, node, rows, h1, h2) of ``df`` over its whole-number ``key``, stored; level 0 holds the leaves, a null key is in leaf null."""
    columns = sorted(df.columns)
    leaf = F.shiftright(F.col(key).cast("bigint"), LEAF_BITS)
    leaves = stored(df.groupBy(leaf.alias("node")).agg(*_marks(columns)).withColumn("level", F.lit(0)))
    # up to the level where any two keys meet: a fixed number, as keys are longs
    up = F.explode(F.sequence(F.lit(0), F.lit((64 - LEAF_BITS) // FANOUT_BITS)))
    climbed = leaves.select(up.alias("level"), "node", "rows", "h1", "h2")
    above = F.expr(f"shiftright(node, level * {FANOUT_BITS})")
    return stored(climbed.groupBy("level", above.alias("node")).agg(*[F.sum(c).alias(c) for c in ("rows", "h1", "h2")]))


def differing_leaves(left: DataFrame, right: DataFrame) -> DataFrame:
    """Leaves of two trees that differ; each level looks only below the nodes that differ on the one above."""
    top = (64 - LEAF_BITS) // FANOUT_BITS
    open_nodes = None
    for level in range(top, -1, -1):
        sides = [t.filter(F.col("level") == level).select("node", F.struct("rows", "h1", "h2").alias(n)) for t, n in ((left, "a"), (right, "b"))]
        if open_nodes is not None:
            parent = F.shiftright("node", FANOUT_BITS)
            sides = [s.withColumn("_parent", parent).join(open_nodes, F.col("_parent").eqNullSafe(F.col("_open")), "left_semi").drop("_parent") for s in sides]
        a, b = sides[0], sides[1].withColumnRenamed("node", "_node")
        both = a.join(b, F.col("node").eqNullSafe(F.col("_node")), "full")
        differing = both.filter(~F.col("a").eqNullSafe(F.col("b"))).select(F.coalesce("node", "_node").alias("_open"))
        open_nodes = stored(differing) if level in (0, top // 2) else differing
    return open_nodes.withColumnRenamed("_open", "leaf")


def differing_groups(left: DataFrame, right: DataFrame, key: str, trees: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(key, left_rows, right_rows): keys whose rows are not the same multiset on both sides, columns compared by name.

    ``trees`` are the stored trees of both sides, built here if absent.  A null key is a group of its own.  Rows are told apart by
    128 bits of hashes summed over a group.
    """
    a, b = trees or (tree(left, key), tree(right, key))
    leaves = differing_leaves(a, b)
    found = sorted(r[0] for r in leaves.filter("leaf IS NOT NULL").limit(RANGES + 1).collect())
    null = leaves.filter("leaf IS NULL").count() > 0
    leaf = F.shiftright(F.col(key).cast("bigint"), LEAF_BITS)

    def wanted(df: DataFrame) -> DataFrame:
        if len(found) > RANGES:
            return df.join(leaves, leaf.eqNullSafe(F.col("leaf")), "left_semi")
        inside = F.col(key).isNull() if null else F.lit(False)
        for low, high in _runs(found):
            inside = inside | F.col(key).between(low << LEAF_BITS, ((high + 1) << LEAF_BITS) - 1)
        return df.filter(inside)

    sides = [
        wanted(df).groupBy(F.col(key).alias(f"_k{n}")).agg(F.struct(*_marks(sorted(df.columns))).alias(f"_s{n}"))
        for df, n in ((left, 0), (right, 1))
    ]
    both = sides[0].join(sides[1], F.col("_k0").eqNullSafe(F.col("_k1")), "full").filter(~F.col("_s0").eqNullSafe(F.col("_s1")))
    return both.select(
        F.coalesce("_k0", "_k1").alias(key), *[F.coalesce(f"_s{n}.rows", F.lit(0)).alias(name) for n, name in ((0, "left_rows"), (1, "right_rows"))]
    )


def _runs(numbers: Sequence[int]) -> list[tuple[int, int]]:
    """Neighbouring numbers as (first, last)."""
    out: list[tuple[int, int]] = []
    for n in numbers:
        if out and out[-1][1] == n - 1:
            out[-1] = (out[-1][0], n)
        else:
            out.append((n, n))
    return out
