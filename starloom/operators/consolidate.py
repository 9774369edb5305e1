"""Completeness consolidation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def consolidate(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the most complete one, its gaps filled from the others.

    The best row has the fewest null or blank columns; ties and gap filling
    follow ``order``, which should be total (Q14).  All of it is one grouped
    aggregate with partial results per task, so a hot key costs one buffer per
    task and not one task for the whole group.
    """
    values = [c for c in df.columns if c not in order or c == key]
    texts = {c for c, kind in df.dtypes if kind == "string"}

    def missing(name: str) -> Column:
        column = F.col(name)
        return column.isNull() | (column == "") if name in texts else column.isNull()

    gaps = sum((F.when(missing(c), 1).otherwise(0) for c in values[1:]), F.when(missing(values[0]), 1).otherwise(0))
    position = F.struct(*order)
    attributes = [c for c in values if c != key]
    scored = df.withColumns({"_gaps": gaps, "_position": position})
    best = F.min_by(F.struct(*attributes), F.struct("_gaps", "_position")).alias("_best")
    first_known = [
        F.min_by(F.col(c), F.when(~missing(c), F.col("_position"))).alias(f"_first_{c}") for c in attributes
    ]
    grouped = scored.groupBy(key).agg(best, *first_known)

    def merged(name: str) -> Column:
        own = F.col(f"_best.{name}")
        known = F.when(own != "", own) if name in texts else own
        # with no value anywhere in the group the row keeps what it had
        return F.coalesce(known, F.col(f"_first_{name}"), own).alias(name)

    return grouped.select(*[F.col(key) if c == key else merged(c) for c in df.columns if c in values])
