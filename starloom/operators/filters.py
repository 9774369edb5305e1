"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.fixed_values import GRADUATE_DEGREES
from starloom.functions.numbers import to_double
from starloom.functions.text import as_column, filled, graduated_status, text_of


def without_unknown(df: DataFrame, key: str) -> DataFrame:
    """F1."""
    return df.filter(F.col(key) > 0)


def with_value(df: DataFrame, *columns: str) -> DataFrame:
    """all the columns are neither null nor blank."""
    for column in columns:
        df = df.filter(filled(column))
    return df


def is_domestic(country: Column | str) -> Column:
    """country missing, blank or containing BRASIL in any case."""
    text = text_of(country)
    return text.isNull() | (text == "") | F.upper(text).contains("BRASIL")


def is_any_of(value: Column | str, allowed: Iterable[str]) -> Column:
    """upper-case value in the list; null is false."""
    return F.coalesce(F.upper(text_of(value)).isin(list(allowed)), F.lit(False))


def is_graduate(degree: Column | str, status: Column | str, months: Column | str) -> Column:
    """a counted degree, and a graduate's status or a positive duration.

    The words are searched inside the status, so the filled-in status "NÃO
    INFORMADO" counts too (it contains "FORMADO"); that is kept as it is.
    """
    positive = F.coalesce(to_double(months) > 0, F.lit(False))
    return is_any_of(degree, GRADUATE_DEGREES) & (graduated_status(status) | positive)


def at_maximum(df: DataFrame, column: str) -> DataFrame:
    """rows that hold the largest value.

    The maximum is one row; the equi-join turns into a broadcast hash join on it.
    """
    top = df.agg(F.max(column).alias("_top"))
    return df.join(F.broadcast(top), F.col(column) == F.col("_top"), "left_semi")


def in_subquery(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """``key IN (SELECT key FROM other)``."""
    return df.join(other.select(key), key, "left_semi")


def active_only(df: DataFrame) -> DataFrame:
    """rows not soft-deleted."""
    return df.filter(F.col("ativo"))


def name_matches_year(name: Column | str, years: Iterable[int | str] | None, skip: str | None = None) -> Column:
    """file or resource name mentions one of the years and not the marker ``skip``."""
    text = as_column(name)
    kept = F.lit(True) if not years else text.rlike("|".join(str(y) for y in years))
    return kept & ~text.contains(skip) if skip else kept


def year_in_name(name: Column | str) -> Column:
    """The last four-digit part between underscores, null when there is none."""
    stem = F.regexp_replace(as_column(name), r"\.parquet$", "")
    years = F.filter(F.split(stem, "_"), lambda part: part.rlike(r"^\d{4}$"))
    return F.when(F.size(years) > 0, F.element_at(years, -1))
