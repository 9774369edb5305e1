"""Versioned tables with an atomic switch.

    path/data/<name>/...           rows of one load, never changed
    path/_versions/<number>.json   manifest of a version: its data folders with their row counts

A load writes a new data folder, then its manifest under a name that no reader looks at, and then renames the manifest to
the next number.  That one rename is the switch: before it readers see the old version, after it the
new one, and a load that stops anywhere else leaves only files that nobody reads (``sweep`` removes them).  The rename fails if
the number is taken, so of two loads at once one is told to try again.  The file system must rename
atomically, as HDFS and local disks do.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from starloom.sources.files import Files
from starloom.sources.writers import LoadReport, observed


@dataclass(frozen=True)
class Version:
    """Manifest of one version."""

    number: int
    folders: dict[str, int]  # data folder: rows
    note: str = ""
    extra: dict = field(default_factory=dict)  # what a kind of table keeps beside its folders

    @property
    def rows(self) -> int:
        return sum(self.folders.values())


class ConcurrentLoad(RuntimeError):
    """Another load was committed first."""


class VersionedTable:
    """A table at ``path``; every method leaves one whole version readable wherever it stops."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)

    # -- reading

    def versions(self) -> list[Version]:
        """All versions, the oldest first; the last is the current one."""
        numbers = sorted(int(n[:-5]) for n in self.files.names(f"{self.path}/_versions") if n.endswith(".json") and n[:-5].isdigit())
        return [self._manifest(n) for n in numbers]

    def _manifest(self, number: int) -> Version:
        held = json.loads(self.files.read(f"{self.path}/_versions/{number:010d}.json"))
        return Version(number, held["folders"], held["note"], held["extra"])

    def current(self) -> Version | None:
        return next(reversed(self.versions()), None)

    def read(self, number: int | None = None) -> DataFrame:
        """Rows of a version, the current one by default."""
        version = self.current() if number is None else self._manifest(number)
        if version is None:
            raise FileNotFoundError(f"{self.path} has no version")
        return self.spark.read.parquet(*[f"{self.path}/data/{f}" for f in version.folders])

    def damaged(self, number: int | None = None) -> list[str]:
        """Data folders whose rows, by their footers, are not those of the manifest."""
        version = self.current() if number is None else self._manifest(number)
        return [f for f, rows in version.folders.items() if self.spark.read.parquet(f"{self.path}/data/{f}").count() != rows]

    # -- writing

    def load(self, df: DataFrame, mode: str = "replace", partition_by: list[str] | None = None, note: str = "") -> LoadReport:
        """Write ``df`` as a new version: instead of the current rows, or with mode ``append`` besides them.

        An empty frame is skipped and reported, as in the other sinks.  The report counts rows as they were
        written against those of the footers; a difference is an error and nothing is switched.
        """
        if mode not in ("replace", "append"):
            raise ValueError(f"unknown mode {mode!r}")
        if df.isEmpty():
            return LoadReport(self.path, 0, 0, skipped=True)
        base = self.current()
        if mode == "append" and base is not None and self.read(base.number).schema != _nullable(df):
            raise ValueError("rows to append have another schema than the table")
        folder = uuid.uuid4().hex
        written = self._write(df, folder, partition_by)
        found = self.spark.read.parquet(f"{self.path}/data/{folder}").count()
        if found != written:
            raise RuntimeError(f"{written} rows were written, {found} are found")
        kept = dict(base.folders) if mode == "append" and base is not None else {}
        self._switch(base, {**kept, folder: found}, note)
        return LoadReport(self.path, written, sum(kept.values()) + found, sum(kept.values()))

    def restore(self, number: int) -> Version:
        """Make an old version the current one again, as a new version of the same data."""
        old = self._manifest(number)
        return self._switch(self.current(), old.folders, f"restores {number}", old.extra)

    def _write(self, df: DataFrame, folder: str, partition_by: list[str] | None) -> int:
        counted, counter = observed(df)
        writer = counted.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.path}/data/{folder}")
        return counter.get["rows"]

    def _switch(self, base: Version | None, folders: dict[str, int], note: str, extra: dict | None = None) -> Version:
        number = (base.number if base else 0) + 1
        staged = f"{self.path}/_versions/.{uuid.uuid4().hex}"
        self._stage(staged, json.dumps({"folders": folders, "note": note, "extra": extra or {}}))
        self._commit(staged, f"{self.path}/_versions/{number:010d}.json")
        return Version(number, folders, note, extra or {})

    def _stage(self, staged: str, manifest: str) -> None:
        self.files.write(staged, manifest)

    def _commit(self, staged: str, target: str) -> None:
        if not self.files.rename_new(staged, target):
            self.files.delete(staged)
            raise ConcurrentLoad(f"{target} was committed by another load")

    # -- releasing

    def release(self, number: int) -> None:
        """Remove an old version: its manifest first, then the data that no other version names."""
        if number == getattr(self.current(), "number", None):
            raise ValueError("the current version can't be released")
        self.files.delete(f"{self.path}/_versions/{number:010d}.json")
        self.sweep()

    def sweep(self) -> list[str]:
        """Remove what no version names: data of loads that stopped, staged manifests.  Not while another load runs."""
        named = {f for v in self.versions() for f in (*v.folders, *v.extra.get("log", ()))}
        loads = {f.split("/")[0] for f in named}
        odd = [f"{self.path}/data/{n}" for n in self.files.names(f"{self.path}/data") if n not in loads]
        nested = {f.split("/")[0] for f in named if "/" in f}  # loads of several parts, some of them replaced since
        odd += [f"{self.path}/data/{n}/{m}" for n in sorted(nested) for m in self.files.names(f"{self.path}/data/{n}") if "=" in m and f"{n}/{m}" not in named]
        odd += [f"{self.path}/_versions/{n}" for n in self.files.names(f"{self.path}/_versions") if n.startswith(".") and not n.endswith(".crc")]
        for path in odd:
            self.files.delete(path)
        return odd


def _nullable(df: DataFrame):
    """The schema of ``df`` as Parquet gives it back: every column may be null."""
    return type(df.schema).fromJson(_free(df.schema.jsonValue()))


def _free(node):
    if isinstance(node, dict):
        return {k: True if k in ("nullable", "containsNull", "valueContainsNull") else _free(v) for k, v in node.items()}
    return [_free(x) for x in node] if isinstance(node, list) else node
