"""Helpers for operators that work on Arrow batches inside tasks.

A batch is cut into pieces of bounded text size, so memory in a task depends on
``PIECE_BYTES`` and on the longest single text, never on the number of rows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.session import ensure_checkpoint_dir

PIECE_BYTES = 1 << 20
PIECE_ROWS = 4096


def pieces(batch: pa.RecordBatch, column: str | None = "text") -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of at most ``PIECE_ROWS`` rows and about ``PIECE_BYTES`` of ``column`` (one row at least)."""
    if batch.num_rows == 0:
        return
    if column is None:
        sizes = np.zeros(batch.num_rows, np.int64)
    else:
        sizes = np.diff(offsets_and_bytes(batch.column(column))[0])
    ends = np.cumsum(sizes)
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        stop = int(np.searchsorted(ends, before + PIECE_BYTES, "right"))
        stop = min(max(stop, begin + 1), begin + PIECE_ROWS, batch.num_rows)
        yield batch.slice(begin, stop - begin)
        begin = stop


def offsets_and_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 (one more than rows) and UTF-8 bytes of a string array; null counts as empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], whole[offsets[0] : offsets[-1]]


def append_columns(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], dict[str, pa.Array]]],
    added: str,
    *,
    text: str | None = "text",
) -> DataFrame:
    """``df`` with the columns of the DDL ``added``, computed batch by batch.

    ``make`` runs once per task and returns the function that computes the new
    columns of a piece.  A column of ``df`` with the name of an added one is
    replaced (names compare without case, as Spark does).
    """
    schema = _schema(df.sparkSession, added)
    taken = {f.name.lower() for f in schema}
    names = [f.name for f in schema]
    drop = [c for c in df.columns if c.lower() in taken]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for piece in pieces(batch, text):
                new = compute(piece)
                old = [(n, piece.column(n)) for n in piece.schema.names if n not in drop]
                yield pa.RecordBatch.from_arrays(
                    [a for _, a in old] + [new[n] for n in names], names=[n for n, _ in old] + names
                )

    out = type(schema)([f for f in df.schema if f.name not in drop] + list(schema))
    return df.mapInArrow(run, out)


def append_steps(df: DataFrame, steps: list[tuple[Callable, str]], *, text: str | None = "text") -> DataFrame:
    """:func:`append_columns` for several (make, added) one after another, in one worker for each task."""
    added = ", ".join(a for _, a in steps)

    def make():
        computes = [m() for m, _ in steps]

        def compute(piece: pa.RecordBatch) -> dict[str, pa.Array]:
            out: dict[str, pa.Array] = {}
            for step in computes:
                new = step(piece)
                out |= new
                kept = [(n, piece.column(n)) for n in piece.schema.names if n not in new]
                piece = pa.RecordBatch.from_arrays([a for _, a in kept] + list(new.values()), names=[n for n, _ in kept] + list(new))
            return out

        return compute

    return append_columns(df, make, added, text=text)


def map_rows(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], Iterator[dict[str, pa.Array]]]],
    out: str,
    *,
    text: str | None = "text",
    finish: bool = False,
) -> DataFrame:
    """Frame with the columns of the DDL ``out``: the batches that ``make()`` yields for each piece.

    With ``finish`` the function is called once more with None at the end of a task.
    """
    names = [f.name for f in _schema(df.sparkSession, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for piece in pieces(batch, text):
                for new in compute(piece):
                    yield pa.RecordBatch.from_arrays([new[n] for n in names], names=names)
        if finish:
            for new in compute(None):
                yield pa.RecordBatch.from_arrays([new[n] for n in names], names=names)

    return df.mapInArrow(run, _schema(df.sparkSession, out))


def _schema(spark: SparkSession, ddl: str):
    importable(spark)
    return StructType.fromDDL(ddl)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, if they have no other place."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the ids kept for measuring; an id of null is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


class Scratch:
    """Tables in the shared checkpoint folder, each removable as soon as nothing reads it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        self.paths: list[str] = []

    def keep(self, df: DataFrame, *folders: str) -> DataFrame:
        """Write ``df`` and read it back: lineage ends here, and a lost executor costs nothing.

        A later filter on the columns ``folders`` reads only the folders that it names.
        """
        path = f"{self.folder}/{len(self.paths)}"
        self.paths.append(path)
        df.write.partitionBy(*folders).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def append(self, df: DataFrame, path: str | None = None) -> str:
        """Write ``df`` to a new table or add it to the one at ``path``; the table's path, for results that come in blocks."""
        if path is None:
            path = f"{self.folder}/{len(self.paths)}"
            self.paths.append(path)
        df.write.mode("append").parquet(path)
        return path

    def remove(self, df: DataFrame | None = None) -> None:
        """Remove the table that ``df`` was read from, or all of them."""
        wanted = set(df.inputFiles()) if df is not None else None
        for path in self.paths:
            if wanted is None or any(f"{path.split(':')[-1]}/" in f for f in wanted):
                where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession):
    """A :class:`Scratch` whose tables go when the block ends."""
    own = Scratch(spark)
    try:
        yield own
    finally:
        own.remove()
