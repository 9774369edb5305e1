"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.fixed_values import AGE_BANDS, DAYS_PER_MONTH, NOT_INFORMED, WEEKDAYS
from starloom.functions.text import as_column, text_of

MICROS_PER_DAY = 86_400_000_000


# two digits that are no day, or no month behind the day, such as 99/99/9999 for an unknown date
IMPOSSIBLE_DAY = r"^(?:00|3[2-9]|[4-9][0-9]|[0-9]{2}/(?:00|1[3-9]|[2-9][0-9]))/"


def day_month_year(value: Column | str) -> Column:
    """Date in dd/MM/yyyy, null when the text does not fit.

    Each text that the parser can't read costs it exceptions, so texts that surely are no date are not handed to it.
    """
    text = F.trim(text_of(value))
    return F.when(text.contains("/") & ~text.rlike(IMPOSSIBLE_DAY), F.try_to_date(text, "dd/MM/yyyy"))


def any_timestamp(value: Column | str) -> Column:
    """X25, free form: ISO text first, then dd/MM/yyyy; null when neither fits."""
    text = F.trim(text_of(value))
    return F.coalesce(text.try_cast("timestamp"), F.try_to_timestamp(text, F.lit("dd/MM/yyyy")))


def calendar_columns(day: Column | str) -> dict[str, Column]:
    """Year, half, quarter, month, day, weekday name and weekend flag."""
    date = as_column(day)
    weekday = F.weekday(date)
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    return {
        "ano": F.year(date),
        "semestre": F.when(F.month(date) > 6, 2).otherwise(1),
        "trimestre": F.quarter(date),
        "mes": F.month(date),
        "dia": F.dayofmonth(date),
        "dia_semana": F.element_at(names, weekday + 1),
        "fim_de_semana": F.when(weekday >= 5, "S").otherwise("N"),
    }


def age_in_year(base_year: Column | str, birth: Column | str) -> Column:
    """Years between birth year and base year; 0 when the birth date is missing."""
    return F.coalesce(as_column(base_year) - F.year(as_column(birth)), F.lit(0)).cast("int")


def months_between_days(start: Column | str, end: Column | str) -> Column:
    """Whole days / 30.44, halves to even; 0 when a date is missing."""
    micros = F.unix_micros(as_column(end).cast("timestamp")) - F.unix_micros(as_column(start).cast("timestamp"))
    days = F.floor(micros / F.lit(MICROS_PER_DAY))
    return F.coalesce(F.bround(days / F.lit(DAYS_PER_MONTH), 0), F.lit(0)).cast("int")


def age_band(age: Column | str) -> Column:
    """Bands closed on the right from 1 to 100; others are not informed."""
    value = as_column(age)
    band = F.when(value.isNull() | (value <= 0), NOT_INFORMED)
    for upper, label in AGE_BANDS:
        band = band.when(value <= upper, label)
    return band.otherwise(NOT_INFORMED)


def stay_status(end: Column | str) -> Column:
    """Finished when there is an end date, else active."""
    return F.when(as_column(end).isNotNull(), "CONCLUÍDO").otherwise("ATIVO")
