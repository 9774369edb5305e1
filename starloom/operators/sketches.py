"""Mergeable profiles (A3, A12): one sketch state per part of a table, merged on demand.

Exact distinct counts have to move every distinct value.  A state is a few kilobytes whatever it has seen, so the states of
yearly or daily parts are stored once, and any choice of parts is profiled by merging them, without the rows.

* distinct values: HyperLogLog of 2^``HLL_BITS`` registers, relative standard error ``HLL_ERROR``;
* quantiles of numbers: KLL of size ``KLL_SIZE``, rank error about ``KLL_ERROR`` with 99 % confidence.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType, StructType, TimestampNTZType, TimestampType

HLL_BITS = 14
HLL_ERROR = 1.04 / 2 ** (HLL_BITS / 2)
KLL_SIZE = 400
KLL_ERROR = 0.0075


def value_text(df: DataFrame, name: str) -> Column:
    """Text that two values of a column share exactly when they are equal for a distinct count; null for null."""
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (ArrayType, StructType)):
        return F.when(value.isNotNull(), F.to_json(F.struct(value.alias("v"))))
    if isinstance(kind, TimestampType):  # the same wall clock may come twice
        return F.unix_micros(value).cast("string")
    if isinstance(kind, TimestampNTZType):
        return value.cast("string")
    if kind.typeName() in ("double", "float"):  # -0.0 equals 0.0
        return (value + F.lit(0).cast(kind)).cast("string")
    return F.base64(value) if kind.typeName() == "binary" else value.cast("string")


def stacked(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(``by``, column number ``c``, text ``v``) for each value that is not null, all columns in one pass."""
    cells = F.array(*[F.struct(F.lit(i).alias("c"), value_text(df, c).alias("v")) for i, c in enumerate(columns)])
    return df.select(*by, F.explode(cells).alias("_cell")).select(*by, "_cell.*").filter("v IS NOT NULL")


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct values of each column as one row: one stack, cut to distinct cells in each task before it moves."""
    cells = stacked(df, columns).distinct()
    return cells.agg(*[F.count_if(F.col("c") == i).alias(c) for i, c in enumerate(columns)])


def sketch(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per part ``by`` and column: rows, nulls, least and largest number, and the two sketch states.

    ``least``, ``most`` and ``kll`` are null for columns without numbers.  The frame is meant to be stored beside the table.
    """
    def state(name: str) -> Column:
        value, numeric = F.col(f"`{name}`"), isinstance(df.schema[name].dataType, NumericType)
        number = value.cast("double") if numeric else F.lit(None).cast("double")
        return F.struct(
            F.lit(name).alias("column"), F.count(F.lit(1)).alias("rows"), F.count_if(value.isNull()).alias("nulls"),
            F.min(number).alias("least"), F.max(number).alias("most"),
            F.hll_sketch_agg(value_text(df, name), F.lit(HLL_BITS)).alias("hll"),
            (F.kll_sketch_agg_double(number, F.lit(KLL_SIZE)) if numeric else F.lit(None).cast("binary")).alias("kll"),
        )

    # one partial state per task, part and column moves
    each = df.groupBy(*by).agg(*[state(c).alias(f"_s{i}") for i, c in enumerate(columns)])
    return each.select(*by, F.explode(F.array(*[f"_s{i}" for i in range(len(columns))])).alias("_s")).select(*by, "_s.*")


def merged(sketches: DataFrame, by: Sequence[str] = (), quantiles: Mapping[str, float] = {}) -> DataFrame:
    """Profile of the merged states: one row per ``by`` and column, with estimates ``distinct`` and one column per quantile.

    Merging is associative, so it doesn't matter which parts were merged before or how often.
    """
    out = sketches.groupBy(*by, "column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.hll_union_agg("hll").alias("hll"), F.kll_merge_agg_double("kll").alias("kll"),
    )
    measured = F.when(F.col("rows") > F.col("nulls"), F.hll_sketch_estimate("hll")).otherwise(F.lit(0))
    numbers = F.col("most").isNotNull()
    return out.select(
        *by, "column", "rows", "nulls", "least", "most", measured.alias("distinct"),
        *[F.when(numbers, F.kll_sketch_get_quantile_double("kll", F.lit(float(q)))).alias(n) for n, q in quantiles.items()],
        "hll", "kll",
    )
