"""Declared constraints as Spark checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.bloom import bloom, might_hold
from starloom.session import stored


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def outside_range(df: DataFrame, column: str, low: object, high: object) -> DataFrame:
    """Rows that break ``CHECK (column BETWEEN low AND high)``; null passes."""
    return df.filter(~F.col(column).between(low, high))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per NOT NULL column, one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullability."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "ordinal_position int, column_name string, data_type string, is_nullable boolean"
    )


def orphan_keys(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Foreign keys without a member and the fact rows that hold them.

    The fact is counted per key before the shuffle, so a hot key is one row.
    """
    used = fact.filter(F.col(fact_key).isNotNull()).groupBy(fact_key).agg(F.count("*").alias("rows"))
    return used.join(dim.select(F.col(dim_key).alias(fact_key)), fact_key, "left_anti")


def orphan_rows(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Whole fact rows without a member; a null key has none.

    Which keys are orphans is found on the keys alone.  A Bloom filter of them is then tested in the scan of the fact, so of its
    wide rows only orphans and the filter's false positives move, to be joined exactly.
    """
    lost = stored(orphan_keys(fact, dim, fact_key, dim_key).select(fact_key))
    near = fact.filter(F.col(fact_key).isNotNull() & might_hold(bloom(lost, fact_key), F.col(fact_key)))
    return near.join(lost, fact_key, "left_semi").unionByName(fact.filter(F.col(fact_key).isNull())).select(*fact.columns)


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """The same measure from two sides per group, with the difference; an absent side is 0."""
    joined = left.select(*keys, F.col(measure).alias("left_value")).join(
        right.select(*keys, F.col(measure).alias("right_value")), list(keys), "full"
    )
    values = {side: F.coalesce(F.col(side), F.lit(0)) for side in ("left_value", "right_value")}
    return joined.withColumns(values).withColumn("difference", F.col("left_value") - F.col("right_value"))


def star_report(
    tables: Mapping[str, DataFrame], primary_keys: Mapping[str, Sequence[str]],
    foreign_keys: Sequence[tuple[str, str, str, str]],
) -> DataFrame:
    """Violations of every declared key of a star, one row per constraint.

    ``foreign_keys`` lists (fact, fact column, dimension, dimension key).
    """
    checks = []
    for table, keys in primary_keys.items():
        if table in tables:
            extra = duplicate_keys(tables[table], keys).agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("violations"))
            checks.append(extra.select(F.lit(f"pk {table}({', '.join(keys)})").alias("constraint"), "violations"))
    for fact, column, dim, key in foreign_keys:
        if fact in tables and dim in tables and column in tables[fact].columns:
            lost = orphan_keys(tables[fact], tables[dim], column, key).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))
            checks.append(lost.select(F.lit(f"fk {fact}.{column} -> {dim}").alias("constraint"), "violations"))
    report = checks[0]
    for check in checks[1:]:
        report = report.unionByName(check)
    return report


def all_zero(df: DataFrame, column: str) -> DataFrame:
    """One row saying whether an identifier is 0 in every row of a non-empty table."""
    return df.agg(F.count("*").alias("total"), F.count_if(F.col(column) != 0).alias("non_zero")).withColumn(
        "suspicious", (F.col("total") > 0) & (F.col("non_zero") == 0)
    )
