"""Aggregates.

Distinct counts are planned by Spark as two steps (distinct on group and value,
then count), so a hot group is spread by its values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.numbers import percentage
from starloom.operators.sketches import distinct_counts


def count_rows(df: DataFrame, name: str = "total") -> DataFrame:
    """Row count as a one-row table."""
    return df.agg(F.count("*").alias(name))


def count_by(df: DataFrame, keys: Sequence[Column | str], name: str = "total") -> DataFrame:
    """A2: rows per group, largest first, ties by the keys."""
    grouped = df.groupBy(*keys).agg(F.count("*").alias(name))
    return grouped.orderBy(F.desc(name), *[c for c in grouped.columns if c != name])


def distinct_by(
    df: DataFrame, keys: Sequence[Column | str], distinct: Mapping[str, str], rows: str | None = None,
    sums: Mapping[str, str] | None = None,
) -> DataFrame:
    """A4, A5: distinct values, optional row count and sums per group."""
    measures = [F.count_distinct(F.col(source)).alias(name) for name, source in distinct.items()]
    if rows:
        measures.append(F.count("*").alias(rows))
    measures += [F.sum(source).alias(name) for name, source in (sums or {}).items()]
    return df.groupBy(*keys).agg(*measures)


def profile(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values of many columns in one pass; a sketch when asked for (see :mod:`starloom.operators.sketches`)."""
    if approximate:
        return df.agg(*[F.approx_count_distinct(F.col(c)).alias(c) for c in columns])
    return distinct_counts(df, columns)


def distinct_list(df: DataFrame, keys: Sequence[str], value: str, name: str, separator: str = ", ") -> DataFrame:
    """Distinct values per group in their own order, joined as text.

    Duplicates go away in the partial aggregate; what is collected is the list
    that the report prints.
    """
    ordered = F.array_sort(F.collect_set(F.col(value)))
    text = F.array_join(F.transform(ordered, lambda v: v.cast("string")), separator)
    return df.groupBy(*keys).agg(text.alias(name))


def first_by(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Values of the first row per group in a stated order."""
    first = F.min_by(F.struct(*values), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, *[f"_first.{v}" for v in values])


def conditional_counts(conditions: Mapping[str, Column]) -> list[Column]:
    """A10: one count per condition."""
    return [F.count_if(condition).alias(name) for name, condition in conditions.items()]


def match_ratio(df: DataFrame, matched: Column) -> DataFrame:
    """Rows, matched rows and their share in percent."""
    counted = df.agg(F.count("*").alias("total"), F.count_if(matched).alias("matched"))
    return counted.withColumn("match_pct", percentage(F.col("matched"), F.col("total")))


def top(df: DataFrame, k: int, by: Sequence[Column | str]) -> DataFrame:
    """O2: the first k rows; planned as a bounded top-k, not as a full sort."""
    return df.orderBy(*by).limit(k)


def value_distribution(df: DataFrame, column: str, name: str = "total") -> DataFrame:
    """Rows per value, largest value first."""
    return df.groupBy(column).agg(F.count("*").alias(name)).orderBy(F.desc(column))
