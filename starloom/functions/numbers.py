"""Number expressions that never raise on dirty text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.text import INTEGRAL, as_column, text_of

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_double(value: Column | str) -> Column:
    """Finite number in the text, else null (so 'nan' and '12d' are null)."""
    text = text_of(value)
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def safe_float(value: Column | str, default: float = 0.0) -> Column:
    """X4."""
    return F.coalesce(to_double(value), F.lit(float(default)))


def safe_int(value: Column | str, default: int = 0) -> Column:
    """Through double, cut toward zero, ``default`` when there is no number."""
    return F.coalesce(to_double(value).try_cast("bigint"), F.lit(default).cast("bigint"))


def whole_number(df: DataFrame, name: str, default: int = 0) -> Column:
    """X5 by column type: columns that are whole numbers already only lose their nulls."""
    if dict(df.dtypes)[name] in INTEGRAL:
        return F.coalesce(F.col(name).cast("bigint"), F.lit(default).cast("bigint"))
    return safe_int(name, default)


def at_least_zero(value: Column | str) -> Column:
    """X29."""
    return F.greatest(as_column(value), F.lit(0))


def months_to_years(months: Column | str) -> Column:
    """One decimal, halves go to the even digit."""
    return F.bround(as_column(months).cast("double") / 12, 1)


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole; null for an empty whole."""
    return F.when(whole > 0, part.cast("double") * 100 / whole)
