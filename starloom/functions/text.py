"""Text expressions.  Every function takes and returns a Column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.fixed_values import (
    BLANK_WORDS,
    GRADUATE_STATUS_WORDS,
    NOT_INFORMED,
)


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def text_of(value: Column | str) -> Column:
    return as_column(value).cast("string")


def clean_text(value: Column | str) -> Column:
    """Null to '', every run of white space to one space, trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(text_of(value), F.lit("")), r"\s+", " "))


def only_digits(value: Column | str) -> Column:
    return F.regexp_replace(F.coalesce(text_of(value), F.lit("")), "[^0-9]", "")


def tax_number(value: Column | str) -> Column:
    """The digits when there are exactly 11 of them, else ''."""
    digits = only_digits(value)
    return F.when(F.length(digits) == 11, digits).otherwise(F.lit(""))


def blank_to_null(value: Column | str) -> Column:
    """Trim, then blanks and the words for a missing value become null."""
    trimmed = F.trim(text_of(value))
    return F.when(~trimmed.isin(BLANK_WORDS), trimmed)


INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def id_text(df: DataFrame, name: str) -> Column:
    """X7 by column type: an id as text, whole numbers without '.0' or exponent."""
    kind, column = dict(df.dtypes)[name], F.col(name)
    if kind in INTEGRAL:
        return column.cast("string")
    if kind in ("float", "double") or kind.startswith("decimal"):
        whole = column.try_cast("bigint")
        return F.when(whole == column, whole.cast("string")).otherwise(column.cast("string"))
    return without_float_suffix(column)


def identifier_of(df: DataFrame, name: str) -> Column:
    """X6 by column type: whole-number columns need no text clean-up."""
    text = id_text(df, name)
    return text if dict(df.dtypes)[name] in INTEGRAL else identifier(text)


def identifier(value: Column | str) -> Column:
    """Trimmed upper-case key without a trailing '.0'; null for a missing key.

    Only the end of the text loses '.0' (ledger Q4), so '1.05' stays as it is.
    """
    trimmed = F.trim(text_of(value))
    key = F.upper(F.regexp_replace(trimmed, r"\.0$", ""))
    return F.when((key != "") & ~F.lower(trimmed).isin("nan", "none", "null", "<na>"), key)


def without_float_suffix(value: Column | str) -> Column:
    """X7 on text: '177173.0' to '177173'."""
    return F.regexp_replace(F.trim(text_of(value)), r"\.0$", "")


def float_id(value: Column | str) -> Column:
    """X7 on numbers: 177173.0 to '177173'; null when there is no number."""
    number = as_column(value)
    return number.try_cast("double").try_cast("bigint").cast("string")


def match_name(value: Column | str) -> Column:
    """Upper-case trimmed name; null when blank, so that blanks never match."""
    name = F.upper(F.trim(text_of(value)))
    return F.when(name != "", name)


def title_words(value: Column | str) -> Column:
    """Capital after every character that is not a letter ('Bem-Estar')."""
    words = F.split(F.lower(text_of(value)), r"(?<=\P{L})(?=\p{L})")
    return F.array_join(F.transform(words, F.initcap), "")


def zero_pad(value: Column | str, width: int) -> Column:
    """Pad on the left; longer text stays whole."""
    text = text_of(value)
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def truncate(value: Column | str, width: int) -> Column:
    """At most ``width`` characters."""
    return F.substring(text_of(value), 1, width)


def split_terms(value: Column | str) -> Column:
    """Trimmed terms between newlines, '|', '/', ';' and ','; null gives one blank term."""
    pieces = F.split(F.coalesce(text_of(value), F.lit("")), r"[\n\r|/;,]")
    return F.transform(pieces, lambda piece: F.trim(piece))


def prefix_number(value: Column | str, width: int) -> Column:
    """The leading ``width`` characters as a number, else null."""
    return F.substring(text_of(value), 1, width).try_cast("int")


def region_initials(value: Column | str) -> Column:
    """First two letters, upper case, 'Ç' written 'C'."""
    return F.translate(F.upper(F.substring(text_of(value), 1, 2)), "Ç", "C")


def is_state_code(value: Column | str) -> Column:
    """Exactly two capital letters."""
    return F.coalesce(text_of(value).rlike("^[A-Z]{2}$"), F.lit(False))


def yes_flag(value: Column | str) -> Column:
    """SIM or S is true, everything else false (ledger Q23)."""
    return F.coalesce(F.upper(F.trim(text_of(value))).isin("SIM", "S"), F.lit(False))


def filled(value: Column | str) -> Column:
    """neither null nor blank."""
    text = text_of(value)
    return F.coalesce(F.trim(text) != "", F.lit(False))


def sex_code(value: Column | str) -> Column:
    """M, F or O; null when blank."""
    text = F.upper(F.trim(text_of(value)))
    return (
        F.when(~filled(value), F.lit(None).cast("string"))
        .when(text.startswith("M"), "M")
        .when(text.startswith("F"), "F")
        .otherwise("O")
    )


def degree_level(value: Column | str) -> Column:
    """Level of a degree; the first word that fits wins."""
    text = F.upper(text_of(value))
    return (
        F.when(text.contains("MESTRADO"), "MESTRE")
        .when(text.contains("DOUTORADO"), "DOUTOR")
        .otherwise("OUTROS")
    )


def graduated_status(value: Column | str) -> Column:
    """F5, text half: the status contains one of the words for a graduate."""
    return F.coalesce(F.upper(text_of(value)).rlike("|".join(GRADUATE_STATUS_WORDS)), F.lit(False))


def author_type(value: Column | str) -> Column:
    """Null to 'not informed', '-' to external participant."""
    text = text_of(value)
    return F.when(text == "-", "PARTICIPANTE EXTERNO").otherwise(F.coalesce(text, F.lit(NOT_INFORMED)))


def public_or_private(status: Column | str, private_value: str = "Particular") -> Column:
    """PRIVADO for the private legal status, PÚBLICO for all others."""
    return F.when(text_of(status) == private_value, "PRIVADO").otherwise("PÚBLICO")


def append_note(note: Column | str, addition: Column | str) -> Column:
    """Existing note, ' | ', addition; only the addition when there is no note."""
    added = F.lit(addition) if isinstance(addition, str) else addition
    return F.concat(F.coalesce(F.concat(as_column(note), F.lit(" | ")), F.lit("")), added)


def recode(value: Column | str, codes: dict[str, str]) -> Column:
    """X11: replace the exact values listed, keep all others."""
    source = as_column(value)
    if not codes:
        return source
    result = None
    for old, new in codes.items():
        result = F.when(source == old, new) if result is None else result.when(source == old, new)
    return result.otherwise(source)


def default_if_blank(value: Column | str, default: str) -> Column:
    """X17 on trimmed text: null, blank and 'nan'-like words become ``default``."""
    return F.coalesce(blank_to_null(value), F.lit(default))
