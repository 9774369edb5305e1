"""Sources (S1-S16, S20, S21).

Readers only declare a scan.  Network clients, spreadsheets and paging belong
to the landing step; this package reads what was landed.
"""

from __future__ import annotations

import glob as globbing
import os
import warnings
from collections.abc import Callable, Iterable, Mapping, Sequence
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.fixed_values import GOAL_DESCRIPTORS, GOALS, STATES
from starloom.operators.filters import name_matches_year, year_in_name
from starloom.operators.shape import stack_rows
from starloom.schemas import empty_table

LATIN = "ISO-8859-1"


class SourceMissing(FileNotFoundError):
    """No source of a chain had data."""


def parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """Parquet scan; the column list reaches the scan as its read schema."""
    df = spark.read.options(**(options or {})).parquet(path)
    return df.select(*columns) if columns else df


def _position(line: Column) -> list[Column]:
    """Where a row stands in its input: file, block of the file, row."""
    return [
        F.col("_metadata.file_name").alias("_arquivo"),
        F.col("_metadata.file_block_start").alias("_bloco"),
        line.alias("_linha"),
    ]


def _line_number() -> Column:
    # a block is read by one task from top to bottom, so this grows within it
    return F.monotonically_increasing_id()


def numbered_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S1 with position columns, for operators that need the input order."""
    df = spark.read.parquet(path)
    return df.select("*", *_position(F.col("_metadata.row_index")))


def object_store_options(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options for an S3-compatible store from the environment; absent settings are an error."""
    env = os.environ if env is None else env
    names = {
        "fs.s3a.endpoint": "OBJECT_STORE_ENDPOINT",
        "fs.s3a.access.key": "OBJECT_STORE_ACCESS_KEY",
        "fs.s3a.secret.key": "OBJECT_STORE_SECRET_KEY",
    }
    absent = [variable for variable in names.values() if not env.get(variable)]
    if absent:
        raise ValueError(f"object store settings are absent: {', '.join(absent)}")
    options = {option: env[variable] for option, variable in names.items()}
    endpoint = options["fs.s3a.endpoint"]
    options["fs.s3a.endpoint"] = endpoint if endpoint.startswith("http") else f"http://{endpoint}"
    return {**options, "fs.s3a.path.style.access": "true"}


def object_store_parquet(spark: SparkSession, bucket: str, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan from the object store."""
    return parquet(spark, f"s3a://{bucket}/{key}", columns, object_store_options())


def yearly_parquet(
    spark: SparkSession, folder: str, pattern: str = "add_producao_*.parquet", years: Iterable[int | str] | None = None,
    skip: str = "_autor", options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Files of several years as one scan.

    The filter is on the file name, so Spark drops files before it reads them.
    ``ano_base`` comes from the name where the file has none.
    """
    name = F.col("_metadata.file_name")
    wanted = None if years is None else [str(y) for y in years]
    df = (
        spark.read.options(**(options or {}))
        .option("mergeSchema", True)
        .option("pathGlobFilter", pattern)
        .parquet(folder)
    )
    year = year_in_name(name)
    kept = df.filter(~name.contains(skip))
    if wanted:
        kept = kept.filter(year.isin(wanted))
    known = F.col("ano_base").cast("string") if "ano_base" in df.columns else F.lit(None).cast("string")
    rest = [c for c in df.columns if c != "ano_base"]
    return kept.select(*rest, F.coalesce(known, year).alias("ano_base"))


def first_available(loaders: Sequence[Callable[[], DataFrame | None]], prefer_local: bool | None = None) -> DataFrame:
    """The first loader that gives rows; a failing or empty one passes on to the next.

    Loaders are listed remote first; ``prefer_local`` turns the order round.
    """
    for load in reversed(loaders) if prefer_local else loaders:
        try:
            df = load()
            if df is not None and not df.isEmpty():
                return df
        except (AnalysisException, FileNotFoundError, ValueError) as error:
            warnings.warn(f"source passed over: {str(error).splitlines()[0][:200]}", stacklevel=2)
    raise SourceMissing("no source of the chain has data")


def find_path(explicit: str | None, folder: str, names: Sequence[str], pattern: str | None = None) -> str:
    """The given path, else the first known name, else the first match of the pattern."""
    if explicit:
        if not Path(explicit).exists():
            raise SourceMissing(f"given file not found: {explicit}")
        return str(explicit)
    for name in names:
        if (Path(folder) / name).exists():
            return str(Path(folder) / name)
    for match in sorted(globbing.glob(str(Path(folder) / pattern))) if pattern else []:
        return match
    raise SourceMissing(f"none of {', '.join(names)} in {folder}")


def csv(
    spark: SparkSession, path: str | Sequence[str], separator: str = ",", encoding: str = "UTF-8", multi_line: bool = False
) -> DataFrame:
    """CSV with a header, every column as text, so leading zeros stay.

    Spark splits a large file.  Quoted line breaks need ``multi_line``, which makes
    a file one task.
    """
    return spark.read.csv(
        path, sep=separator, encoding=encoding, header=True, inferSchema=False, multiLine=multi_line, escape='"'
    )


def csv_files(
    spark: SparkSession, paths: Sequence[str], separator: str = ";", encoding: str = LATIN, multi_line: bool = False,
    missing: str = "error",
) -> DataFrame:
    """Several CSV files joined by column name, with file name and load date.

    Each file brings its own header, as column sets differ between years.  A
    file that cannot be opened is an error; with ``missing="skip"`` it is left out with a
    warning that names it, as long as another is left.
    The position columns give "first" and "last" row of a file a meaning.
    """
    frames = []
    for path in sorted(paths):
        try:
            df = csv(spark, path, separator, encoding, multi_line)
            frames.append(df.select("*", F.col("_metadata.file_name").alias("fonte_arquivo"), *_position(_line_number())))
        except AnalysisException:
            if missing != "skip":
                raise SourceMissing(f"CSV file could not be read: {path}") from None
            warnings.warn(f"CSV file left out: {path}", stacklevel=2)
    if not frames:
        raise SourceMissing("no CSV file could be read")
    return stack_rows(frames).withColumn("created_at", F.current_date())


def csv_or_default(
    spark: SparkSession, path: str | None, default: Callable[[], DataFrame], missing: str = "error"
) -> DataFrame:
    """The landed CSV, or literal rows when no path is given.

    A path that cannot be read is an error; with ``missing="skip"`` it gives the literal rows and a warning.
    """
    if path:
        try:
            return csv(spark, path)
        except AnalysisException:
            if missing != "skip":
                raise SourceMissing(f"CSV file could not be read: {path}") from None
            warnings.warn(f"CSV file left out: {path}", stacklevel=2)
    return default()


def record_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed API pages, one row per record; failed and empty pages give none."""
    pages = spark.read.json(path, multiLine=True)
    return pages.filter("success").selectExpr("inline(result.records)")


def records_of(pages: DataFrame, column: str, schema: str) -> DataFrame:
    """The same from a text column that holds a JSON page."""
    page = F.from_json(F.col(column), f"result STRUCT<records: ARRAY<{schema}>>")
    return pages.select(page.alias("_page")).selectExpr("inline(_page.result.records)")


def catalog_resources(catalog: DataFrame, title_has: str, years: Sequence[int]) -> DataFrame:
    """Active resources of the data sets whose title holds a word.

    ``catalog`` has one row per data set (name, title, resources); only
    resources that are active and name one of the years stay, with that year.
    """
    named = F.lower("title").contains(title_has.lower())
    usable = F.exists("resources", lambda r: F.coalesce(r["datastore_active"], F.lit(False)))
    rows = catalog.filter(named & usable).select("name", "title", F.explode("resources").alias("r"))
    year: Column | None = None
    for y in years:
        found = F.col("r.name").contains(str(y))
        year = F.when(found, y) if year is None else year.when(found, y)
    return rows.filter(F.col("r.datastore_active") & name_matches_year("r.name", years)).select(
        "name", "title", F.col("r.id").alias("resource_id"), F.col("r.name").alias("resource_name"),
        (year if year is not None else F.lit(None).cast("int")).alias("ano_referencia"),
    )


def catalog_page(spark: SparkSession, path: str) -> DataFrame:
    """Landed catalog search result, one row per data set."""
    return spark.read.json(path, multiLine=True).selectExpr("inline(result.results)")


def table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table; a missing one of the warehouse is its typed empty frame."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return empty_table(spark, name.split(".")[-1])


def optional_table(spark: SparkSession, name: str) -> DataFrame | None:
    """Catalog table, or None when it is missing."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def table_rows(spark: SparkSession, name: str) -> int:
    """Row count, 0 for a missing table."""
    return spark.table(name).count() if spark.catalog.tableExists(name) else 0


def jdbc(spark: SparkSession, url: str, query: str, split_column: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """Query of an external database, read in parallel over a numeric column."""
    return spark.read.jdbc(
        url, f"({query}) AS source", column=split_column, lowerBound=low, upperBound=high, numPartitions=parts,
        properties=options,
    )


def states(spark: SparkSession) -> DataFrame:
    """The 27 states."""
    return spark.createDataFrame(STATES, "codigo_uf int, sigla_uf string, nome_uf string, regiao string")


def goals(spark: SparkSession) -> DataFrame:
    """The 20 goals with their descriptors."""
    rows = [(number, name, text, GOAL_DESCRIPTORS[number]) for number, name, text, _ in GOALS]
    return spark.createDataFrame(rows, "ods_numero int, ods_nome string, ods_descricao string, descritores string")


def days(spark: SparkSession, first: str | Column, last: str | Column, bounds: DataFrame | None = None) -> DataFrame:
    """One row per day, both ends included; ends may be columns of a one-row frame."""
    def day(value: str | Column) -> Column:
        return value if isinstance(value, Column) else F.to_date(F.lit(value))

    source = bounds if bounds is not None else spark.range(1)
    return source.select(F.explode(F.sequence(day(first), day(last))).alias("data"))
