"""Exact top-k search (operator 2) by distributed histogram selection.

Scores are inner products of vectors quantised to floor(64 x).  Queries are taken in blocks
of at most ``QUERY_BLOCK`` rows (a broadcast of bounded size); the candidates stay where they are.
For a block, every task scores all its candidates and counts the scores of each query in
``BINS`` bins; Spark sums the counts, which shows the bin that holds the k-th best score of all.
The next pass splits that bin, until it is one score wide.  A last pass keeps what beats the k-th
score and as many ties as could be needed, and a window breaks ties by id.  The result of a block is written before the
next one begins, so neither the plan nor what is broadcast grows with the queries.

A task reports bins from the top only as far as its own k-th score: the k-th of all can't be lower.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.batches import Scratch, map_rows

SCALE = 64
QUERY_BLOCK = 8192
BINS = 256
RESULT = "query_id long, rank int, vec_id long, score long"
_CELLS = 1 << 21  # scores held at once in a task


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<long>): rows with an id and a vector of finite components only, floor(64 x) of each."""
    # try_cast: what no long can hold becomes null and is refused below
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).try_cast("long"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)) & (F.size("embedding") > 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _scores(rows: Iterator[pa.RecordBatch], query: tuple[np.ndarray, np.ndarray], exact: type):
    """(ids, scores queries x candidates) of slices of bounded size; a query's own row scores the least long."""
    ids, q = query
    q = q.astype(exact)
    step = max(1, _CELLS // max(1, len(ids)))
    order = np.argsort(ids, kind="stable")
    for batch in rows:
        v, own = _matrix(batch.column("v")).astype(exact), batch.column("vec_id").to_numpy()
        for a in range(0, len(own), step):
            part = own[a : a + step]
            scores = (q @ v[a : a + step].T).astype(np.int64)
            low, high = np.searchsorted(ids[order], part, "left"), np.searchsorted(ids[order], part, "right")
            for j in np.flatnonzero(high > low):
                scores[order[low[j] : high[j]], j] = np.iinfo(np.int64).min
            yield part, scores


def _histogram(vectors: DataFrame, held: Broadcast, exact, low: np.ndarray, width: np.ndarray, k: int) -> DataFrame:
    """(q, bin, n): counts of each query's scores from ``low`` in bins of ``width``; bin BINS holds all above."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = held.value
        counts = np.zeros((len(low), BINS + 1), np.int64)
        row = np.arange(len(low))[:, None] * (BINS + 1)
        for _, scores in _scores(batches, query, exact):
            bins = np.minimum((scores - low[:, None]) // width[:, None], BINS)
            valid = scores >= low[:, None]
            counts += np.bincount((bins + row)[valid], minlength=counts.size).reshape(counts.shape)
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        q, b = np.nonzero((counts > 0) & (above < k))
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(b), pa.array(counts[q, b])], names=["q", "bin", "n"])

    return vectors.mapInArrow(count, "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))


def _block(vectors: DataFrame, query, held: Broadcast, exact, bound: int, k: int) -> DataFrame:
    """(q, query_id, vec_id, score): for each query all that beat its k-th score, and enough ties; ``held`` is ``query``."""
    n = len(query[0])
    norm = np.abs(query[1].astype(np.float64)).sum(axis=1)
    reach = np.ceil(norm * bound).astype(np.int64) + 1
    low, width = -reach, (2 * reach) // BINS + 1
    going = True
    while going:
        table = _histogram(vectors, held, exact, low, width, k).toArrow()
        counts = np.zeros((n, BINS + 1), np.int64)
        counts[table.column("q").to_numpy(), table.column("bin").to_numpy()] = table.column("n").to_numpy()
        reached = counts[:, ::-1].cumsum(axis=1)[:, ::-1] >= k
        at = np.where(reached.any(axis=1), reached.shape[1] - 1 - reached[:, ::-1].argmax(axis=1), 0)
        fewer = ~reached.any(axis=1)  # fewer than k candidates: all are wanted
        low = np.where(fewer, low, low + at * width)
        width = np.where(fewer, 1, width)
        going = bool((width > 1).any())
        width = np.maximum(1, -(-width // BINS))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, least = held.value, low
        q_all, v_all, s_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        size = 0

        def pruned():
            q, v, s = (np.concatenate(x) for x in (q_all, v_all, s_all))
            order = np.lexsort((v, -s, q))
            q, v, s = q[order], v[order], s[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
            keep = rank < k
            return [q[keep]], [v[keep]], [s[keep]]

        for ids, scores in _scores(batches, query, exact):
            i, j = np.nonzero(scores >= least[:, None])
            q_all.append(i)
            v_all.append(ids[j])
            s_all.append(scores[i, j])
            size += len(i)
            if size > _CELLS:
                q_all, v_all, s_all = pruned()
                size = len(q_all[0])
        (q,), (v,), (s,) = pruned()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (q, query[0][q], v, s)], names=["q", "query_id", "vec_id", "score"])

    return vectors.mapInArrow(select, "q long, query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for each row of ``queries`` (both ``vec_id``, ``embedding``).

    Ties go to the smaller id.  A query never finds rows of its own id.  Rows without an id, null or empty
    vectors and vectors with null or non-finite components take no part, as query or candidate; vectors
    of different lengths don't meet.  Rows of one id are candidates each; equal query rows ask once.
    A product that a long can't hold raises an error.  No rows give no rows.
    """
    rows = scratch.keep(quantised(vectors).withColumn("dim", F.size("v")))
    asked = scratch.keep(quantised(queries).distinct().withColumn("dim", F.size("v")))
    spark, written = vectors.sparkSession, None
    largest = rows.groupBy("dim").agg(
        F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("most"), F.sum(F.exists("v", lambda x: x.isNull()).cast("int")).alias("odd")
    ).collect()
    for dim, most, odd in sorted(largest):
        own, wanted = rows.where(F.col("dim") == dim), asked.where(F.col("dim") == dim)
        total = wanted.count()
        if not total:
            continue
        if odd or dim * most * most >= 2**62:
            raise ValueError("scores of these vectors don't fit in a long")
        exact = np.float32 if dim * most * most < 2**24 else np.float64 if dim * most * most < 2**53 else np.int64
        blocks = -(-total // QUERY_BLOCK)
        block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
        for b in range(blocks):
            table = wanted.where(block == b).orderBy("vec_id", "v").toArrow()
            if not table.num_rows:
                continue
            query = (table.column("vec_id").to_numpy(), _matrix(table.column("v")))
            held = spark.sparkContext.broadcast(query)
            found = _block(own, query, held, exact, most, k)
            order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
            best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            written = scratch.append(best.select("query_id", "rank", "vec_id", "score"), written)
            held.destroy()
    if written is None:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(written)
