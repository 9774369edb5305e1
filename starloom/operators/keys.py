"""Surrogate keys (K1-K4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.fixed_values import SK_COLUMN, UNKNOWN_MEMBER
from starloom.session import by_loaded_size, stored

# monotonically_increasing_id: partition number in the upper bits, row in the lower 33
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def surrogate_key(df: DataFrame, name: str, order: Sequence[Column | str]) -> DataFrame:
    """K1, K4: keys 1..n in the given order, on all executors.

    ``order`` must be a total order.  Rows are range-partitioned and sorted, and
    stored with their position (partition, row), so that neither a lost executor
    nor a new plan can move a row between the two passes.  Only the row count
    per partition, one number each, is summed up in one place; the second pass
    adds those offsets in a projection.
    """
    if not order:
        raise ValueError("a surrogate key needs an order that is total")
    columns = [F.col(o) if isinstance(o, str) else o for o in order]
    placed = stored(
        df.repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn("_position", F.monotonically_increasing_id())
    )
    part = F.shiftright("_position", _ROW_BITS)
    sizes = placed.groupBy(part.cast("int").alias("part")).agg(F.count("*").alias("rows")).orderBy("part").collect()
    # one number per range partition: bounded by the shuffle width, not by the data
    filled = {size["part"]: size["rows"] for size in sizes}
    offsets = list(accumulate((filled.get(i, 0) for i in range(max(filled, default=0))), initial=0))
    # a constant array, folded once by the optimizer
    offset = F.element_at(F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>"), part.cast("int") + 1)
    row = F.col("_position").bitwiseAND(F.lit(_ROW_MASK))
    return placed.select((offset + row + 1).alias(name), *df.columns)


def extend_keys(known: DataFrame, rows: DataFrame, name: str, business: Sequence[str]) -> DataFrame:
    """K1 for later loads: keys of the business keys in ``rows`` that ``known`` (``name``, business columns) lacks.

    They are numbered behind the largest known key in their own order; what was assigned before is neither sorted nor
    changed.  Equal business keys get one key, null counts as a value.  Append the result to ``known``
    (:class:`starloom.sources.versions.VersionedTable` does it in one step).
    """
    same = F.lit(True)
    new = rows.select(*business).distinct()
    for c in business:
        same = same & new[c].eqNullSafe(known[c])
    unseen = new.join(known, same, "left_anti")
    largest = known.agg(F.max(name)).scalar()
    return surrogate_key(unseen, "_nth", business).select((F.col("_nth") + F.coalesce(largest, F.lit(0))).alias(name), *business)


def small_surrogate_key(df: DataFrame, name: str, order: Sequence[Column | str]) -> DataFrame:
    """K1 for calendars and goals, whose size does not grow with the data."""
    columns = [F.col(o) if isinstance(o, str) else o for o in order]
    return df.select(F.row_number().over(Window.orderBy(*columns)).alias(name), *df.columns)


def with_unknown_member(df: DataFrame, member: Mapping[str, object]) -> DataFrame:
    """K2: add one row with the given values; all other columns are null."""
    row = df.sparkSession.range(1).select(*[
        F.lit(member.get(field.name)).cast(field.dataType).alias(field.name) for field in df.schema.fields
    ])
    return row.unionByName(df)


def with_unknown(df: DataFrame, dimension: str) -> DataFrame:
    """K2: add the registered unknown member (key 0) of a dimension."""
    return with_unknown_member(df, {SK_COLUMN[dimension]: 0, **UNKNOWN_MEMBER[dimension]})


def factorized(df: DataFrame, name: str, parts: Sequence[str]) -> DataFrame:
    """K3: dense ids from 1 over the sorted distinct values of one or more columns.

    Several columns form the text key ``a||b``; it decides the order.  The ids
    are assigned on the distinct values only, then joined back; the id table is
    broadcast while its rows are few, whatever its files take.
    """
    key = F.col(parts[0]) if len(parts) == 1 else F.concat_ws("||", *[F.coalesce(F.col(p), F.lit("")) for p in parts])
    keyed = df.withColumn("_key", key)
    ids = surrogate_key(keyed.select("_key").distinct(), name, ["_key"])
    return keyed.join(by_loaded_size(ids), keyed["_key"].eqNullSafe(ids["_key"]), "left").drop("_key")
