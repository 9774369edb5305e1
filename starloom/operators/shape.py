"""Projection and schema shaping.

Column names are decided on the driver from ``df.columns``; what reaches Spark
is a plain ``select``, so pruning and push-down work through it.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.fixed_values import SK_COLUMN
from starloom.functions.text import blank_to_null, truncate
from starloom.functions.numbers import to_double


def select_renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The listed columns that exist, renamed, in the listed order.

    When several sources map to one target they are coalesced in listed order
    (ledger Q12).
    """
    sources: dict[str, list[str]] = {}
    for source, target in names.items():
        if source in df.columns:
            sources.setdefault(target, []).append(source)
    return df.select(*[
        (F.coalesce(*[F.col(f"`{c}`") for c in found]) if len(found) > 1 else F.col(f"`{found[0]}`")).alias(target)
        for target, found in sources.items()
    ])


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of ``names`` that exist in ``df``."""
    return [name for name in names if name in df.columns]


def first_present(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """The first candidate that exists."""
    return next(iter(present(df, candidates)), None)


def first_filled(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """P3 with ledger Q3: the first existing candidate with any value.

    A column that exists but holds only nulls does not block the later ones.
    Costs one scan that returns a single row; skipped for a single candidate.
    """
    found = present(df, candidates)
    if len(found) <= 1:
        return found[0] if found else None
    has_value = df.agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in found]).first()
    return next((c for c in found if has_value[c]), found[0])


def resolve_aliases(
    df: DataFrame, aliases: Mapping[str, Sequence[str]], keep: Iterable[str] = ()
) -> DataFrame:
    """One column per target from its first existing candidate, null when there is none."""
    columns = []
    for target, candidates in aliases.items():
        source = first_present(df, candidates)
        columns.append((F.col(source) if source else F.lit(None).cast("string")).alias(target))
    return df.select(*columns, *present(df, keep))


def find_like(df: DataFrame, exact: str, keywords: Iterable[str]) -> str | None:
    """The column named ``exact``, else the first whose lower-case name contains a keyword."""
    if exact in df.columns:
        return exact
    words = [word.lower() for word in keywords]
    return next((c for c in df.columns if any(word in c.lower() for word in words)), None)


def _ascii(name: str) -> str:
    return unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode("ascii")


def snake_name(name: str) -> str:
    """P5: accents off, other characters to one underscore, lower case."""
    return re.sub(r"[^0-9a-zA-Z]+", "_", _ascii(name)).strip("_").lower()


def light_name(name: str) -> str:
    """Trimmed lower case, blank and dash to underscore, double underscores halved."""
    return name.strip().lower().translate(str.maketrans(" -", "__")).replace("__", "_")


# Word rules of the institution feed.
NAME_WORDS = {"codigo": "cod", "nome": "des", "quantidade": "qtd"}
NAME_PREFIXES = {"cd_": "cod_", "ds_": "des_", "nm_": "des_"}


def feed_name(name: str) -> str:
    """ASCII lower case with the word and prefix rules; a final '_id' gets '_original' (Q26)."""
    text = re.sub(r"\s+", "_", re.sub(r"[^a-z0-9\s_]", "", _ascii(name.strip().lower())))
    for prefix, replacement in NAME_PREFIXES.items():
        if text.startswith(prefix):
            text = replacement + text[len(prefix):]
    for word, replacement in NAME_WORDS.items():
        text = text.replace(word, replacement)
    return f"{text}_original" if text.endswith("_id") else text


def rename_all(df: DataFrame, rule) -> DataFrame:
    """Every column through a naming rule."""
    return df.toDF(*[rule(c) for c in df.columns])


def with_defaults(df: DataFrame, defaults: Mapping[str, Column | object]) -> DataFrame:
    """Add the columns that are absent."""
    missing = {name: value for name, value in defaults.items() if name not in df.columns}
    return df.withColumns({n: v if isinstance(v, Column) else F.lit(v) for n, v in missing.items()}) if missing else df


def with_lineage(df: DataFrame, source: Column | str) -> DataFrame:
    """Where a row came from and the day it was loaded."""
    origin = F.lit(source) if isinstance(source, str) else source
    return df.withColumns({"fonte_arquivo": origin, "created_at": F.current_date()})


def leading(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """P10: the listed columns first, the rest after in their own order."""
    head = present(df, first)
    return df.select(*head, *[c for c in df.columns if c not in head])


def stack_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name, absent columns null."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def drop_empty(df: DataFrame) -> DataFrame:
    """Drop columns without any value, then rows without any value.

    One aggregate finds the empty columns; only its single row reaches the driver.
    """
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[f"`{c}`" for c in df.columns if counts[c]]).dropna("all")


def blanks_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """P13 on the given columns, by default on every text column."""
    names = present(df, columns) if columns else [c for c, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: blank_to_null(F.col(f"`{c}`")) for c in names}) if names else df


def apply_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the columns that exist; what does not fit becomes null."""
    def typed(name: str, kind: str) -> Column:
        if kind in ("int", "bigint", "smallint"):
            return to_double(name).try_cast(kind)
        return F.col(name).try_cast(kind)

    found = {c: typed(c, kind) for c, kind in types.items() if c in df.columns}
    return df.withColumns(found) if found else df


def fit_varchar(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Cut text columns to their width; the word 'nan' is a missing value."""
    found = {}
    for name, width in limits.items():
        if name in df.columns:
            cut = truncate(name, width)
            found[name] = F.when(cut != "nan", cut)
    return df.withColumns(found) if found else df


def standard_sk(df: DataFrame, dimension: str) -> DataFrame:
    """Give the key column its registered name: another '*_sk', 'sk' or 'id' is renamed."""
    wanted = SK_COLUMN[dimension]
    if wanted in df.columns:
        return df
    others = [c for c in df.columns if c.endswith("_sk")] + ["sk", "id"]
    source = first_present(df, others)
    return df.withColumnRenamed(source, wanted) if source else df


def with_natural_id(df: DataFrame, target: str, hint: str) -> DataFrame:
    """``target`` from the first id-like column that mentions ``hint``.

    Without one, the id is a content hash: it needs no global row number and is
    the same on every run.  Equal rows are numbered, so that all of them stay.
    """
    if target in df.columns:
        return df
    source = next((c for c in df.columns if "id" in c.lower() and hint in c.lower()), None)
    if source:
        return df.withColumn(target, F.col(source).cast("string"))
    hashed = df.withColumn(target, F.md5(F.to_json(F.struct(*df.columns))))
    copy = F.row_number().over(Window.partitionBy(target).orderBy(target))
    return hashed.withColumn("_copy", copy).withColumn(
        target, F.when(F.col("_copy") == 1, F.col(target)).otherwise(F.concat_ws("-", target, F.col("_copy").cast("string")))
    ).drop("_copy")


def nulls_filled(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Default per column, on nulls only."""
    return df.fillna({c: v for c, v in defaults.items() if c in df.columns})
