"""Tables that are loaded file by file.

The manifest of a version is a ledger: every file with its size, time, header and the folder of its rows.  A load lists the source,
reads only files that are new or changed, leaves out the rows of files that are gone, and switches all of it at once.
A file counts as unchanged while its size and its time are the same.  The list is taken before the files are
read, so a file that changes meanwhile is taken again by the next load.  A file without a byte is as good as gone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.fixed_values import POSITION
from starloom.operators.shape import stack_rows
from starloom.sources.readers import csv_files
from starloom.sources.versions import VersionedTable
from starloom.sources.writers import observed

# files that one job reads: a file has its own header and so its own branch of the plan
FILES_PER_JOB = 64
ADDED = {*POSITION, "fonte_arquivo", "created_at"}


@dataclass(frozen=True)
class LedgerReport:
    """What a load found; files by their full path."""

    new: list[str]
    changed: list[str]
    vanished: list[str]
    unchanged: int
    new_columns: dict[str, list[str]]  # file: columns that no earlier file had
    rows: int  # of the table after the load


def one_csv(spark: SparkSession, path: str) -> DataFrame:
    return csv_files(spark, [path])


def one_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("fonte_arquivo"))


class LedgerTable(VersionedTable):
    """A versioned table of the rows of many files."""

    def files_held(self) -> dict[str, dict]:
        """The ledger: file to its size, modified, header, rows and folder."""
        version = self.current()
        return dict(version.extra["files"]) if version else {}

    def read(self, number: int | None = None) -> DataFrame:
        """Rows of a version, joined by column name; a column that a file lacks is null."""
        version = self.current() if number is None else self._manifest(number)
        if version is None or not version.folders:
            raise FileNotFoundError(f"{self.path} holds no rows")
        return self.spark.read.option("mergeSchema", True).parquet(*[f"{self.path}/data/{f}" for f in version.folders])

    def listed(self, source: str, pattern: str = "*") -> dict[str, tuple[int, int]]:
        """Files of a folder with size and time; Spark lists them and reads none."""
        found = self.spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(source)
        rows = found.select("path", "length", F.unix_millis("modificationTime").alias("modified")).collect()
        return {r["path"]: (r["length"], r["modified"]) for r in rows}

    def update(
        self, source: str, pattern: str = "*", reader: Callable[[SparkSession, str], DataFrame] = one_csv, vanished: str = "drop"
    ) -> LedgerReport:
        """Load what is new or changed; ``vanished`` says whether rows of files that are gone go too or stay ("keep").

        ``reader`` gives the rows of one file.  Without any difference nothing is written and no version is made.
        """
        if vanished not in ("drop", "keep"):
            raise ValueError(f"unknown treatment {vanished!r}")
        base, held, there = self.current(), self.files_held(), self.listed(source, pattern)
        new = sorted(there.keys() - held.keys())
        changed = sorted(p for p in there.keys() & held.keys() if there[p] != (held[p]["size"], held[p]["modified"]))
        gone = sorted(held.keys() - there.keys())
        kept = {p: entry for p, entry in held.items() if p not in changed and not (vanished == "drop" and p in gone)}
        # a new column is one that no earlier file had, also those that are replaced now
        known = {c for entry in held.values() for c in entry["header"]}
        taken, added = {}, {}
        for path, entry in self._load_files([*new, *changed], there, reader):
            unseen = [c for c in entry["header"] if c not in known]
            if unseen and held:
                added[path] = unseen
            taken[path] = entry
        ledger = {**kept, **taken}
        rows = sum(entry["rows"] for entry in ledger.values())
        if taken or len(kept) < len(held):
            folders = {e["folder"]: e["rows"] for e in ledger.values() if e["folder"]}
            self._switch(base, folders, f"{len(new)} new, {len(changed)} changed, {len(gone)} gone", {"files": ledger})
        return LedgerReport(new, changed, gone, len(there) - len(taken), added, rows)

    def _load_files(self, paths: list[str], there: dict, reader: Callable) -> Iterable[tuple[str, dict]]:
        for start in range(0, len(paths), FILES_PER_JOB):
            batch = paths[start:start + FILES_PER_JOB]
            frames = [reader(self.spark, p) for p in batch]
            load = uuid.uuid4().hex
            # a file's rows are one folder, so that a later load can leave it out
            counted, counter = observed(stack_rows([df.withColumn("_ficheiro", F.lit(i)) for i, df in enumerate(frames)]))
            counted.write.partitionBy("_ficheiro").parquet(f"{self.path}/data/{load}")
            filled = any("=" in n for n in self.files.names(f"{self.path}/data/{load}"))
            found = self.spark.read.parquet(f"{self.path}/data/{load}").groupBy("_ficheiro").count().collect() if filled else []
            rows = {r["_ficheiro"]: r["count"] for r in found}
            if sum(rows.values()) != counter.get["rows"]:
                raise RuntimeError(f"{counter.get['rows']} rows were written, {sum(rows.values())} are found")
            for i, (path, df) in enumerate(zip(batch, frames, strict=True)):
                size, modified = there[path]
                yield path, {
                    "size": size, "modified": modified, "header": [c for c in df.columns if c not in ADDED], "rows": rows.get(i, 0),
                    "folder": f"{load}/_ficheiro={i}" if i in rows else None,
                }
