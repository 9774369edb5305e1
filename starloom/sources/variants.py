"""Landed JSON whose shape is not known or drifts, by way of VARIANT.

A page is parsed once.  Which fields there are and of which kinds is an aggregate over all rows; a value that its declared
type cannot hold becomes null in its column and stays, with its kind and text, in ``_desvios``.  Typed rows are meant to be written first: Spark pushes a filter on them below the parsing, which
then runs for the filter as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.numbers import to_double
from starloom.functions.text import INTEGRAL, blank_to_null

# more fields than this are keys of a map and no columns: an error
MAX_FIELDS = 2000
DEVIATIONS = "array<struct<campo:string,tipo:string,texto:string>>"
NESTED = ("ARRAY", "OBJECT")


def parsed(df: DataFrame, text: str, into: str = "registro") -> DataFrame:
    """One record a row; a null text or one that is not JSON becomes null, which ``typed`` reports."""
    return df.withColumn(into, F.try_parse_json(text))


def page_records(pages: DataFrame, text: str, keep: Sequence[str] = (), into: str = "registro") -> DataFrame:
    """The records of landed pages as VARIANT, with the page's columns ``keep``; failed and empty pages give none."""
    page = parsed(pages.select(*keep, text), text, "_pagina")
    # a condition and no filter, which would be pushed below the parsing and repeat it
    records = F.when(F.try_variant_get("_pagina", "$.success", "boolean"), F.try_variant_get("_pagina", "$.result.records", "variant"))
    found = page.withColumn("_registros", records).lateralJoin(page.sparkSession.tvf.variant_explode(F.col("_registros").outer()))
    # members of an object have a key and are no records
    return found.filter("key IS NULL").select(*keep, F.col("value").alias(into))


def kind(value: Column | str) -> Column:
    """VOID, BOOLEAN, BIGINT, DECIMAL, DOUBLE, STRING, ARRAY or OBJECT; null for no value."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def field_kinds(records: DataFrame, column: str = "registro") -> DataFrame:
    """Rows per field and kind (campo, tipo, linhas) over all records that are objects."""
    members = records.select(column).lateralJoin(records.sparkSession.tvf.variant_explode(F.col(column).outer()))
    named = members.filter("key IS NOT NULL").select(F.col("key").alias("campo"), kind("value").alias("tipo"))
    return named.groupBy("campo", "tipo").agg(F.count("*").alias("linhas"))


def field_types(kinds: DataFrame) -> DataFrame:
    """The type that holds every value of a field (campo, tipo): text where kinds do not go together or nest, void without any value."""
    seen = F.array_remove(F.array_sort(F.collect_set("tipo")), "VOID")
    only = lambda *names: F.size(F.array_except("_k", F.array(*map(F.lit, names)))) == 0
    chosen = (
        F.when(F.size("_k") == 0, "void").when(only("BIGINT"), "bigint").when(only("BIGINT", "DECIMAL", "DOUBLE"), "double")
        .when(only("BOOLEAN"), "boolean").otherwise("string")
    )
    return kinds.groupBy("campo").agg(seen.alias("_k")).select("campo", chosen.alias("tipo"))


def found_types(records: DataFrame, column: str = "registro") -> dict[str, str]:
    """Field to type by all records, in the order of the names, fields without any value left out.

    Only this list reaches the driver.
    """
    rows = field_types(field_kinds(records, column)).filter("tipo != 'void'").limit(MAX_FIELDS + 1).collect()
    if len(rows) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} fields: keys of a map are no columns")
    return {r["campo"]: r["tipo"] for r in sorted(rows)}


def _fitted(value: Column, type_: str) -> tuple[Column, Column]:
    """A member as ``type_``, and whether it has a value that the type does not hold."""
    text = F.try_variant_get(value, "$", "string")
    sort = kind(value)
    given = value.isNotNull() & (sort != "VOID")
    if type_ == "string":
        # nested values stay as JSON text and are reported
        return text, given & sort.isin(*NESTED)
    filled = blank_to_null(text)
    odd = sort.isin(*NESTED) | ((sort == "BOOLEAN") != F.lit(type_ == "boolean")) & (sort != "STRING")
    if type_ in INTEGRAL:
        number = to_double(filled)
        held = F.coalesce(filled.try_cast(type_), number.try_cast(type_))
        odd = odd | F.coalesce(held.cast("double") != number, F.lit(False))
    else:
        held = filled.try_cast(type_)
    misfit = given & filled.isNotNull() & (odd | held.isNull())
    return F.when(~misfit, held), misfit


def typed(
    records: DataFrame, types: Mapping[str, str], keep: Sequence[Column | str] = (), column: str = "registro",
    keys: Mapping[str, Column] | None = None, report_new: bool = True,
) -> DataFrame:
    """Columns ``keep``, the fields of ``types`` and ``_desvios``: what is not held there, null if nothing.

    Reported are values that a type does not hold (a fraction for a whole number, a nested value anywhere), values of fields
    that ``types`` doesn't name, and, with an empty field name, records that are no objects.  Blank texts are missing
    values.  ``keys`` names the member of a field where it is not the field's own name.
    """
    rows = records.select("*", F.col(column).alias("_v")).withColumn("_m", F.try_variant_get("_v", "$", "map<string,variant>"))

    def report(name: Column, value: Column) -> Column:
        return F.struct(name.alias("campo"), F.coalesce(kind(value), F.lit("ILEGIVEL")).alias("tipo"), F.try_variant_get(value, "$", "string").alias("texto"))

    columns, found = [], [F.when(F.col("_m").isNull(), report(F.lit(""), F.col("_v")))]
    for name, type_ in types.items():
        value = F.try_element_at("_m", (keys or {}).get(name, F.lit(name)))
        held, misfit = _fitted(value, type_)
        columns.append(held.alias(name))
        found.append(F.when(misfit, report(F.lit(name), value)))
    every = F.filter(F.array(*found), lambda d: d.isNotNull())
    if report_new:
        names = F.array(*map(F.lit, types)) if types else F.array().cast("array<string>")
        unknown = F.array_sort(F.array_except(F.map_keys("_m"), names))
        new = F.transform(unknown, lambda k: report(k, F.try_element_at(F.col("_m"), k)))
        every = F.concat(every, F.coalesce(F.filter(new, lambda d: d["tipo"] != "VOID"), F.array().cast(DEVIATIONS)))
    return rows.select(*keep, *columns, F.when(F.size(every) > 0, every).alias("_desvios"))


def deviations(rows: DataFrame) -> DataFrame:
    """How often each field deviates, by kind (campo, tipo, linhas)."""
    each = rows.select(F.explode("_desvios").alias("d")).select("d.campo", "d.tipo")
    return each.groupBy("campo", "tipo").agg(F.count("*").alias("linhas"))
