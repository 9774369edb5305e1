"""Deduplication.

Spark rows have no input order, so "first" and "last" take explicit order
columns.  The order is completed with every other sortable column, which makes
the survivor the same on every run.

``row_number() = 1`` is planned as a group limit before the shuffle: each task
keeps one row per key, so a key that holds a third of the rows still sends at
most one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.fixed_values import POSITION


def total_order(df: DataFrame, order: Sequence[Column | str], skip: Sequence[str] = ()) -> list[Column]:
    """The given order, then all remaining sortable columns as tie-breakers."""
    named = {o for o in order if isinstance(o, str)} | set(skip)
    rest = [c for c, kind in df.dtypes if c not in named and not kind.startswith(("map", "variant"))]
    return [F.col(o) if isinstance(o, str) else o for o in order] + [F.col(c) for c in rest]


def input_order(df: DataFrame, last_first: bool = False) -> list[Column]:
    """Position columns that the readers added, if they are there."""
    names = [c for c in POSITION if c in df.columns]
    return [F.desc(c) if last_first else F.asc(c) for c in names]


def without_position(df: DataFrame) -> DataFrame:
    return df.drop(*POSITION)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*total_order(df, order, skip=keys))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str], ties: Sequence[Column | str] = ()) -> DataFrame:
    """The row with the largest ``by`` values of each key, nulls last."""
    return one_per_key(df, keys, [*[F.desc_nulls_last(c) for c in by], *ties])


def distinct_rows(df: DataFrame) -> DataFrame:
    """D1."""
    return df.distinct()


def best_per_pair(df: DataFrame, pair: Sequence[str], score: str) -> DataFrame:
    """One row per pair with its best score; combines before the shuffle."""
    return df.groupBy(*pair).agg(F.max(score).alias(score))
