"""Stored tables that are changed part by part.

The rows lie in parts by ranges of one whole-number key.  A change says which keys it can touch; only the parts of those
keys are read, and only parts in which a row really changed are written anew.  All other files stay as they are, under their
names.  Every change also leaves its rows before and after in a log, which is switched together with
the data.  Switching, old versions and release are those of :class:`starloom.sources.versions.VersionedTable`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.maintain import deactivate, insert_missing, promote
from starloom.session import stored
from starloom.sources.versions import Version, VersionedTable


class RangedTable(VersionedTable):
    """A versioned table in parts by ranges of ``key``; ``pair`` identifies a row."""

    def create(self, df: DataFrame, key: str, pair: Sequence[str], parts: int) -> Version:
        """Store ``df``; the bounds of the parts are quantiles of the key, null keys lie in the first part."""
        cuts = df.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)], F.lit(10_000))).first()[0] if parts > 1 else []
        extra = {"key": key, "pair": list(pair), "bounds": sorted(set(cuts or [])), "log": []}
        return self._switch(self.current(), self._write_parts(df, extra), "create", extra)

    def _part(self, extra: dict) -> Column:
        """Number of the part of a row: how many bounds its key has reached."""
        bounds = F.array(*[F.lit(b) for b in extra["bounds"]]) if extra["bounds"] else F.array().cast("array<bigint>")
        return F.coalesce(F.size(F.filter(bounds, lambda b: b <= F.col(extra["key"]))), F.lit(0))

    def _write_parts(self, df: DataFrame, extra: dict) -> dict[str, int]:
        """Rows of ``df`` in one folder for each part; {folder: rows}."""
        load = uuid.uuid4().hex
        dealt = df.withColumn("_part", self._part(extra)).repartition(F.col("_part"))
        dealt.write.partitionBy("_part").parquet(f"{self.path}/data/{load}")
        found = self.spark.read.parquet(f"{self.path}/data/{load}").groupBy("_part").count().collect()
        return {f"{load}/_part={r['_part']}": r["count"] for r in found}

    def change(self, action: str, transform: Callable[[DataFrame], DataFrame], touched: Callable[[DataFrame], DataFrame]) -> Version:
        """Replace the rows of the touched parts by ``transform`` of them; without a real change nothing is switched.

        ``touched`` gets the table and returns a frame with the key column: every key that the change can touch.
        ``transform`` sees the rows of whole parts and must keep key and pair of the rows it keeps.
        """
        base = self.current()
        extra, pair = base.extra, base.extra["pair"]
        numbers = sorted(r[0] for r in touched(self.read()).select(self._part(extra).alias("p")).distinct().collect())  # at most all parts
        by_part = {int(f.rsplit("=", 1)[1]): f for f in base.folders}
        held = [f"{self.path}/data/{by_part[n]}" for n in numbers if n in by_part]
        if not numbers:
            return base
        schema = self.read().schema
        old = self.spark.read.schema(schema).parquet(*held) if held else self.spark.createDataFrame([], schema)
        columns = old.columns
        inside = F.lit(False)
        for n in numbers:
            inside = inside | (self._part(extra) == n)
        new = stored(transform(old).select(columns).where(inside))
        before, after = (df.select(*pair, F.struct(*columns).alias(side)) for df, side in ((old, "before"), (new, "after")))
        both = F.lit(True)
        for c in pair:
            both = both & before[c].eqNullSafe(after[c])
        key = F.coalesce(*[F.col(f"{side}.{extra['key']}") for side in ("after", "before")])
        moved = before.join(after, both, "full").where(~F.col("before").eqNullSafe(F.col("after")))
        log = stored(moved.select(F.lit(base.number + 1).alias("version"), F.lit(action).alias("action"), "before", "after", key.alias(extra["key"])))
        changed = sorted(r[0] for r in log.select(self._part(extra).alias("p")).distinct().collect())
        if not changed:
            return base
        really = F.lit(False)
        for n in changed:
            really = really | (self._part(extra) == n)
        written = self._write_parts(new.where(really), extra)
        noted = uuid.uuid4().hex
        log.drop(extra["key"]).write.parquet(f"{self.path}/data/{noted}")
        folders = {f: n for f, n in base.folders.items() if int(f.rsplit("=", 1)[1]) not in changed} | written
        return self._switch(base, folders, action, {**extra, "log": [*extra["log"], noted]})

    def read(self, number: int | None = None) -> DataFrame:
        version = self.current() if number is None else self._manifest(number)
        if version is None:
            raise FileNotFoundError(f"{self.path} has no version")
        return self.spark.read.parquet(*[f"{self.path}/data/{f}" for f in version.folders])

    def log(self) -> DataFrame | None:
        """(version, action, before, after) of every row that was changed since the table was made; None without a change."""
        folders = self.current().extra["log"]
        return self.spark.read.parquet(*[f"{self.path}/data/{f}" for f in folders]) if folders else None

    # -- the changes of the theme-goal bridge

    def insert_missing(self, rows: DataFrame) -> Version:
        """M1: add associations whose pair is new."""
        return self.change("insert", lambda old: insert_missing(old, rows, tuple(self.current().extra["pair"])), lambda _: rows)

    def deactivate(self, condition: Column, note: Column | str) -> Version:
        """M2: soft delete with an audit note; rows that are inactive already are noted again, as in the frame operator."""
        return self.change("deactivate", lambda old: deactivate(old, condition, note), lambda table: table.where(condition))

    def promote(self, reviewed: DataFrame, **settings) -> Version:
        """M3: reviewed automatic associations of enough confidence change type and confidence."""
        return self.change("promote", lambda old: promote(old, reviewed, **settings), lambda _: reviewed)
