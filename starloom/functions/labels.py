"""Code-to-label expressions over the fixed tables.

The tables hold 20 to 27 entries, so each label is a literal map inside the
projection: no join, no broadcast, no shuffle (X31-X36).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.fixed_values import (
    CATEGORY_DEFAULT,
    GOALS,
    LAST_OFFICIAL_GOAL,
    MACRO_CATEGORIES,
    MACRO_DEFAULT_FOCUS,
    MACRO_DEFAULT_NAME,
    STATES,
    UNKNOWN_CODE,
)
from starloom.functions.text import as_column, only_digits, text_of


def label_map(pairs: Iterable[tuple[object, object]], key: Column) -> Column:
    """Value of ``key`` in a small literal map, null when absent."""
    cells = [F.lit(cell) for pair in pairs for cell in pair]
    return F.try_element_at(F.create_map(*cells), key)


def state_code(state: Column | str) -> Column:
    """Abbreviation from a state name in any case, or from the code itself (Q18)."""
    text = F.upper(F.trim(text_of(state)))
    names = [(name.upper(), code) for _, code, name, _ in STATES]
    codes = [(code, code) for _, code, _, _ in STATES]
    return F.coalesce(label_map(names + codes, text), F.lit(UNKNOWN_CODE))


def state_code_of_ibge(number: Column | str) -> Column:
    """State abbreviation of a two-digit IBGE state number."""
    return label_map([(ibge, code) for ibge, code, _, _ in STATES], as_column(number).cast("int"))


def region_of_state(code: Column | str) -> Column:
    return label_map([(abbr, region) for _, abbr, _, region in STATES], text_of(code))


def name_of_state(code: Column | str) -> Column:
    return label_map([(abbr, name) for _, abbr, name, _ in STATES], text_of(code))


def goal_category(number: Column | str) -> Column:
    """Theme category of a goal number."""
    known = label_map([(goal, category) for goal, _, _, category in GOALS], as_column(number).cast("int"))
    return F.coalesce(known, F.lit(CATEGORY_DEFAULT))


def _macro_lookup(position: int, number: Column, cross_suffix: str = "") -> Column:
    """Entry of the macro-category table for a goal: main lists before cross-cutting ones."""
    main = [(goal, row[position]) for row in MACRO_CATEGORIES for goal in row[1]]
    cross = [
        (goal, f"{row[position]}{cross_suffix}")
        for row in MACRO_CATEGORIES
        for goal in row[2]
        if goal not in dict(main)
    ]
    return label_map(main + cross, number)


def goal_macro(number: Column | str) -> dict[str, Column]:
    """Macro-category, its associated goals and its focus."""
    goal = as_column(number).cast("int")
    return {
        "ods_macrocategoria": F.coalesce(_macro_lookup(0, goal, " (Transversal)"), F.lit(MACRO_DEFAULT_NAME)),
        "ods_associados": F.coalesce(_macro_lookup(3, goal), F.concat(F.lit("ODS "), goal.cast("string"))),
        "ods_foco_principal": F.coalesce(_macro_lookup(4, goal), F.lit(MACRO_DEFAULT_FOCUS)),
    }


def goal_macro_labels(number: Column | str) -> Column:
    """Every macro-category of a goal, cross-cutting ones marked, in table order."""
    labels: dict[int, list[str]] = {}
    for name, main, cross, _, _ in MACRO_CATEGORIES:
        for goal in main:
            labels.setdefault(goal, []).append(name)
        for goal in cross:
            labels.setdefault(goal, []).append(f"{name} (Transversal)")
    pairs = [(goal, names) for goal, names in sorted(labels.items())]
    cells = [F.lit(goal) if i == 0 else F.array(*[F.lit(n) for n in cell]) for goal, cell in pairs for i in (0, 1)]
    found = F.try_element_at(F.create_map(*cells), as_column(number).cast("int"))
    return F.coalesce(found, F.array().cast("array<string>"))


def goal_number(value: Column | str) -> Column:
    """Goal number from mixed text ('ODS 4') or a number; null without digits."""
    text = text_of(value)
    whole = F.when(text.rlike(r"^\s*\d+\.\d*\s*$"), text.try_cast("double").try_cast("int"))
    return F.coalesce(whole, only_digits(value).try_cast("int"))


def match_note(keyword: Column | str, labels: Column | None = None) -> Column:
    """Note of an automatic match, with the macro-categories when given."""
    base = F.concat(F.lit('Match automático: "'), as_column(keyword), F.lit('" encontrada em descritores ODS'))
    if labels is None:
        return base
    return F.when(
        F.size(labels) > 0, F.concat(base, F.lit("; macrocategoria(s): "), F.array_join(labels, ", "))
    ).otherwise(base)


def goal_kind(number: Column | str) -> Column:
    """Official up to 17, expanded beyond."""
    return F.when(as_column(number) <= LAST_OFFICIAL_GOAL, "Oficial ONU").otherwise("Expandido")
