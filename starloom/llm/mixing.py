"""Mixing sources to target weights (operator 12): balanced sampling by the cube method.

A source with a target of r times its words takes each of its documents floor(r) times, and once more with
probability r - floor(r).  The cube method settles these fractions: the flight takes three undecided
documents of a source and moves their probabilities along the null space of the two balancing constraints
(number of documents, number of words), to and fro with the chances that keep every probability's
expectation, until one of them is 0 or 1.  Both totals stay what they were.  It goes on until ``LANDING``
documents of a source are left; the landing tries all their outcomes and takes the one whose words are nearest
to what is left of the target, then whose number of documents is.

At scale: a source is dealt into shards of about ``SHARD_ROWS`` documents by a hash, so a hot source is many
tasks; only ids and sizes are shuffled.  A task streams through a sorted shard and holds ``LANDING`` + 1 documents of it.
What a shard leaves undecided goes on to the next round, ``FAN`` shards in one, until a source has one shard.
Shards follow from the data alone and every random number from source, shard and round, so the
result doesn't depend on executors or on how files are split.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, VariantType

from starloom.llm.batches import Scratch, importable
from starloom.operators.keys import surrogate_key

# Fixed values of the contract: weights by rank of the source, share of all words, most times a document is taken.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SHARD_ROWS = 1 << 12
FAN = 1 << 8
LANDING = 12
_EDGE = 1e-9  # a probability this near to 0 or 1 has arrived

WORD = r"[^\x20\x09-\x0D]+"


def sized(documents: DataFrame) -> DataFrame:
    """(doc_id, source, size, key): number of words of each text, 0 for null, and a hash that orders and deals the rows.

    Hash order leaves documents of all sizes to the landing, so its outcomes lie close together.
    """
    return documents.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), _key(documents).alias("key"),
    )


def _key(documents: DataFrame):
    def hashable(kind) -> bool:
        return not isinstance(kind, (MapType, VariantType)) and not (isinstance(kind, ArrayType) and not hashable(kind.elementType))

    return F.xxhash64(*[F.col(f"`{f.name}`") for f in documents.schema if hashable(f.dataType)])


def targets(rows: DataFrame, scratch: Scratch, weights: Sequence[float] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source, n, source_size, target): words each source shall give; ``rows`` as :func:`sized` returns them.

    Sources take weights in turn, by code point, null last.  A target stops at ``MOST`` times its source's
    words; what is cut off is shared again by weight until no target is above.  Each round of that is one aggregate over the sources.
    """
    totals = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    ranked = surrogate_key(totals, "rank", [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighted = scratch.keep(ranked.select("source", "n", "source_size", weight.alias("weight")))
    goal = share * (weighted.agg(F.sum("source_size")).first()[0] or 0)
    if share > MOST:
        raise ValueError(f"all documents {MOST} times are less than {share} times all words")
    level, full = 0.0, -1
    while goal:
        above = F.col("weight") * F.lit(level) > F.col("source_size") * MOST
        count, cut, open_weight = weighted.agg(
            F.count_if(above), F.sum(F.when(above, F.col("source_size") * MOST)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if count == full:
            break
        full, level = count, (goal - (cut or 0)) / open_weight if open_weight else float(2**62)
    wanted = F.least(F.col("weight") * F.lit(level), F.col("source_size").cast("double") * MOST)
    return weighted.select("source", "n", "source_size", wanted.alias("target"))


def _step(units: list[list], chance: random.Random) -> None:
    """Move the probabilities (first entry) of three units along the null space of (1, size) until one arrives."""
    (p, a), (q, b), (r, c) = ((u[0], u[1]) for u in units)
    along = (float(b - c), float(c - a), float(a - b)) if not a == b == c else (1.0, -1.0, 0.0)
    forth = min((1 - x) / d if d > 0 else -x / d for x, d in zip((p, q, r), along) if d)
    back = min(x / d if d > 0 else (x - 1) / d for x, d in zip((p, q, r), along) if d)
    way = forth if chance.random() * (forth + back) < back else -back
    for unit, d in zip(units, along):
        unit[0] += way * d


def _landed(units: list[list]) -> list[int]:
    """0 or 1 for each unit: of all outcomes the nearest in words, then in documents, then the first."""
    if not units:
        return []
    outcomes = (np.arange(1 << len(units))[:, None] >> np.arange(len(units))) & 1
    p, size = (np.array([u[i] for u in units], float) for i in (0, 1))
    words = np.round(np.abs(outcomes @ size - p @ size), 6)
    return outcomes[np.lexsort((np.abs(outcomes.sum(axis=1) - p.sum()), words))[0]].tolist()


_UNITS = "doc_id {0}, source string, shard long, shards long, size long, key long, base int, p double, source_size long, target double"


def _round(rows: DataFrame, number: int, kind: str) -> DataFrame:
    """One flight through each (source, shard); where a source is one shard, also the landing.  Decided rows have p 0 or 1."""
    names = ["doc_id", "source", "shard", "shards", "size", "key", "base", "p", "source_size", "target"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, chance, shards = None, [], random.Random(0), 1

        def settle() -> None:
            """All decisions the units in hand allow while more than ``LANDING`` are open."""
            while len(held) > LANDING:
                longest = max(held, key=lambda u: u[1])  # so no giant is left to the landing
                window = [longest, *[u for u in held[:3] if u is not longest][:2]]
                _step(window, chance)
                for unit in window:
                    if not _EDGE < unit[0] < 1 - _EDGE:
                        decided.append((unit[2], float(round(unit[0]))))
                        held.remove(unit)

        def finish() -> None:
            outcome = _landed(held) if shards == 1 else [u[0] for u in held]
            decided.extend((u[2], float(p)) for u, p in zip(held, outcome))
            held.clear()

        kept: list[pa.RecordBatch] = []  # at most LANDING + 1 rows that an earlier batch left open
        schema = None
        for batch in batches:
            schema = batch.schema
            decided: list[tuple[int, float]] = []
            table = pa.Table.from_batches([*kept, batch])
            first = sum(k.num_rows for k in kept)
            for i, unit in enumerate(held):
                unit[2] = i
            keys = zip(*(batch.column(c).to_pylist() for c in ("source", "shard", "shards", "size", "p")))
            for i, (source, shard, of, size, p) in enumerate(keys, first):
                if group != (source, shard):
                    finish()
                    group, shards, chance = (source, shard), of, random.Random(f"{number}:{shard}:{source}:{source is None}")
                if _EDGE < p < 1 - _EDGE and size > 0:
                    held.append([p, size, i])
                    settle()
                else:  # nothing to decide: a whole number of copies, or no words
                    decided.append((i, float(round(p)) if size > 0 else 0.0))
            done = table.take(pa.array([i for i, _ in decided], pa.int64()))
            yield from done.set_column(names.index("p"), "p", pa.array([p for _, p in decided], pa.float64())).to_batches()
            kept = table.take(pa.array([u[2] for u in held], pa.int64())).to_batches()
        if held:
            decided = []
            for i, unit in enumerate(held):
                unit[2] = i
            finish()
            done = pa.Table.from_batches(kept, schema).take(pa.array([i for i, _ in decided], pa.int64()))
            yield from done.set_column(names.index("p"), "p", pa.array([p for _, p in decided], pa.float64())).to_batches()

    importable(rows.sparkSession)
    dealt = rows.repartition("source", "shard").sortWithinPartitions("source", "shard", "key", "doc_id", "size")
    return dealt.select(*names).mapInArrow(run, _UNITS.format(kind))


def mix(documents: DataFrame, scratch: Scratch, weights: Sequence[float] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken, key) for each row of ``documents`` (``doc_id``, ``text``, ``source``).

    ``copies`` is 0 to ``MOST``, ``taken`` that many times ``size``.  Null texts and texts without a word have size 0 and no
    copies.  A null source is a source of its own, the last.  Repeated rows are documents each; null ids are kept.
    Further columns only help to order rows of one size.  No rows, or no words at all, take nothing.
    The probabilities of the last ``LANDING`` documents of a source give way to its target.
    """
    rows = scratch.keep(sized(documents))
    wanted = scratch.keep(targets(rows, scratch, weights, share))
    kind = rows.schema["doc_id"].dataType.simpleString()
    most = wanted.agg(F.max("n")).first()[0] or 0
    shards = F.ceil(F.col("n") / F.lit(float(SHARD_ROWS))).cast("long")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.least(F.floor(times + F.lit(_EDGE)), F.lit(MOST))
    # one row for each source: broadcast while it is small, a join with skew handling beyond
    asked = wanted.select(
        F.col("source").alias("of_source"), shards.alias("shards"), "source_size", "target",
        base.cast("int").alias("base"), F.greatest(times - base, F.lit(0.0)).alias("p"),
    )
    units = rows.join(asked, F.col("source").eqNullSafe(F.col("of_source"))).withColumn("shard", F.pmod("key", "shards"))
    parts, number, left = [], 0, -(-most // SHARD_ROWS)
    while True:
        flown = scratch.keep(_round(units, number, kind))
        undecided = (F.col("p") > 0) & (F.col("p") < 1)
        parts.append(flown.where(~undecided))
        if left <= 1:
            break
        units = flown.where(undecided).withColumn("shard", F.floor(F.col("shard") / FAN)).withColumn(
            "shards", F.ceil(F.col("shards") / FAN).cast("long")
        )
        number, left = number + 1, -(-left // FAN)
    out = parts[0]
    for part in parts[1:]:  # as many as rounds: four for 10^10 documents of a source
        out = out.unionByName(part)
    copies = F.when(F.col("size") > 0, F.col("base") + F.col("p").cast("int")).otherwise(0)
    return out.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "key"
    )


def mixture(documents: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: every row of ``documents`` as often as ``mixed`` (from :func:`mix` of the same rows) says; equal rows share their copies."""
    key, times = "_key", "_times"
    while {key, times} & {c.lower() for c in documents.columns}:
        key, times = "_" + key, "_" + times
    wanted = mixed.groupBy(F.col("key").alias(key)).agg(F.sum("copies").alias(times)).where(F.col(times) > 0)
    one = documents.withColumn(key, _key(documents)).dropDuplicates([key])
    return one.join(wanted, key).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*documents.columns)
