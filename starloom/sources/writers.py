"""Sinks (S17-S19, S22) and table swap (M4)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.sources.files import Files

# Write modes by their public name.
MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


@dataclass(frozen=True)
class LoadReport:
    """Rows sent to a target against rows found in it."""

    target: str
    written: int
    found: int
    before: int = 0
    skipped: bool = False

    @property
    def complete(self) -> bool:
        return self.skipped or self.found == self.before + self.written


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a counter of the rows that pass."""
    counter = Observation()
    return df.observe(counter, F.count(F.lit(1)).alias("rows")), counter


def save_parquet(
    df: DataFrame, path: str, mode: str = "replace", partition_by: list[str] | None = None, rows_per_file: int = 0
) -> LoadReport:
    """Write a parquet dataset; an empty frame is skipped and reported.

    Rows are counted while they are written, and the target by its footers, so
    reconciling does not run the plan again.
    """
    if df.isEmpty():
        return LoadReport(path, 0, 0, skipped=True)
    spark = df.sparkSession
    before = spark.read.parquet(path).count() if mode == "append" and Files(spark).exists(path) else 0  # a target that can't be read is an error
    counted, counter = observed(df)
    writer = counted.write.mode(MODES[mode])
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return LoadReport(path, counter.get["rows"], spark.read.parquet(path).count(), before)


def save_table(df: DataFrame, name: str, mode: str = "replace") -> LoadReport:
    """The same into a catalog table."""
    if df.isEmpty():
        return LoadReport(name, 0, 0, skipped=True)
    spark = df.sparkSession
    before = spark.table(name).count() if mode == "append" and spark.catalog.tableExists(name) else 0
    counted, counter = observed(df)
    counted.write.mode(MODES[mode]).saveAsTable(name)
    return LoadReport(name, counter.get["rows"], spark.table(name).count(), before)


def swap_tables(spark: SparkSession, live: str, fresh: str, backup: str) -> None:
    """M4: the live table becomes the backup, the fresh one becomes live.

    A catalog has no swap of two names: a swap that stopped between its renames is completed by calling it again, and
    if the fresh table is gone the backup becomes live again.  Where readers must never find the name absent, use :class:`starloom.sources.versions.VersionedTable`.
    """
    if not spark.catalog.tableExists(live) and not spark.catalog.tableExists(fresh) and spark.catalog.tableExists(backup):
        spark.sql(f"ALTER TABLE {backup} RENAME TO {live}")
        raise LookupError(f"there is no table {fresh}; {live} was restored from {backup}")
    if spark.catalog.tableExists(live):
        spark.sql(f"DROP TABLE IF EXISTS {backup}")
        spark.sql(f"ALTER TABLE {live} RENAME TO {backup}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {live}")
