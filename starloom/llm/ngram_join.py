"""N-gram Jaccard join (operator 7): adaptive prefixes with several required matches.

Texts become sets of word shingles; a :class:`Rule` says how many words and how similar.  Equal sets are one class from the start, so
exact copies cost nothing later.  A set of n shingles that reaches the threshold
with another shares at least a = ceil(t * n) of them; so under any common order of
shingles, the first n - a + l of one set and of the other have l in common.  Each
class picks its l: a longer prefix means more rows to match, but l matches are asked for
before a pair is verified.  The costs are estimated from shingle frequencies.

* Order: frequent shingles last, by counts over all documents; the most frequent ones
  are told apart, ``FREQUENT`` at most.  The order shapes the cost alone, never the result.
* Shingles in few prefixes: pairs with enough matches are candidates; those that share
  a neighbour are put in one bucket.
* Shingles in more than ``DENSE`` prefixes: listing pairs would grow with the square of a group,
  so the classes that hold them go to a bucket as they are.
* Verification: the classes of a bucket are dealt into blocks; a task gets two blocks, intersects
  all their sets by matrix products and returns a spanning forest of the links only.
* Links become components by star steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm import bloom
from starloom.llm.batches import Scratch, importable, map_rows
from starloom.llm.components import components
from starloom.llm.words import BLANK_SEPARATED, distinct_shingles, mix, words_of
from starloom.operators.bloom import bloom as bloom_of, might_hold

MATCHES = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64)
DENSE = 48
BLOCK_DOCS = 192
FREQUENT = 1 << 22
LEAST_FREQUENT = 4
COUNT_BLOCK = 1 << 22
ODD_BITS = 1 << 23
_ELSEWHERE = 0.05  # other holders that a shingle is expected to have when it isn't frequent
# in rows moved: a match, and a verified candidate for each shingle of its set
_MATCH_COST, _VERIFY_COST = 0.5, 0.8


@dataclass(frozen=True)
class Rule:
    """Words of a shingle, and the least similarity of linked sets in percent."""

    words: int = 5
    percent: int = 80

    def sets(self, piece: pa.RecordBatch) -> list[np.ndarray]:
        return distinct_shingles(words_of(piece.column("text"), BLANK_SEPARATED), self.words)

    def needed(self, n: np.ndarray | int):
        """Shingles that a set of n has in common with any set it links with, at least."""
        return (self.percent * n + 99) // 100


def _frequent(docs: DataFrame, scratch: Scratch, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of all documents, ``FREQUENT`` at most, sorted, and about how many documents hold each.

    A task counts the shingles of blocks of ``COUNT_BLOCK`` and reports those it met twice.  More documents make more
    blocks, so a shingle of the same share of them is met as often in each; its holders are told from what was reported.
    """

    def make():
        held: list[np.ndarray] = []
        size = 0

        def report():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts > 1
            total = pa.array([int(counts.sum())], pa.int64())
            yield {"shingle": pa.nulls(1, pa.int64()), "n": total}
            if often.any():
                yield {"shingle": pa.array(values[often].view(np.int64)), "n": pa.array(counts[often], pa.int64())}

        def compute(piece):
            nonlocal size
            if piece is not None:
                for values in rule.sets(piece):
                    held.append(values)
                    size += len(values)
            if size and (piece is None or size >= COUNT_BLOCK):
                yield from report()
                held.clear()
                size = 0

        return compute

    counts = map_rows(docs.select("text"), make, "shingle long, n long", finish=True)
    sums = scratch.keep(
        counts.groupBy("shingle").agg(F.sum("n").alias("n"), F.count("*").alias("blocks"))
        .where(F.col("shingle").isNull() | (F.col("n") >= LEAST_FREQUENT))
    )
    blocks = sums.where("shingle IS NULL").agg(F.sum("blocks")).first()[0] or 1
    # counts in steps of an eighth of their logarithm: from which step on do they fit?
    often, step = sums.where("shingle IS NOT NULL"), F.floor(F.log("n") * 8)
    steps = often.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).orderBy(F.desc("step")).collect()
    fits = [r["step"] for r, rows in zip(steps, accumulate(r["rows"] for r in steps)) if rows <= FREQUENT]
    often = often.where(step >= F.lit(fits[-1])).select("shingle", "n").toArrow() if fits else often.limit(0).toArrow()
    scratch.remove(sums)
    shingles = often.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], _holders(often.column("n").to_numpy()[order], blocks).astype(np.float32)


def _holders(reported: np.ndarray, blocks: int) -> np.ndarray:
    """Documents that hold a shingle, about, when blocks that met it twice reported it so often in all.

    With r holders a block, dealt by chance, a block reports r (1 - exp(-r)) of them, which is close to r^2 / (1 + r).
    """
    share = reported / blocks
    return blocks * (share + np.sqrt(share * (share + 4))) / 2


def _choose(others: np.ndarray, n: int, base: int) -> int:
    """The number of matches to ask for; ``others``: holders expected of each shingle in prefix order.

    A prefix of ``base`` shingles more than the matches is long enough.
    """
    best, least = 1, np.inf
    for matches in (m for m in MATCHES if m <= n - base):
        rows = float(others[: base + matches].sum())
        cost = base + matches + rows * _MATCH_COST + rows / matches**2 * (1 + _VERIFY_COST * n)
        if cost < least:
            best, least = matches, cost
    return best


def _prefixes(docs: DataFrame, scratch: Scratch, rule: Rule) -> DataFrame:
    """Per document: set size, signature of the set, matches asked for, prefix shingles in order."""
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(docs, scratch, rule))

    def make():
        often, counts = frequent.value
        often = np.append(often, np.uint64(2**64 - 1))  # so that every search ends at an entry
        counts = np.append(counts, np.float32(0))

        def compute(piece):
            n_all, sigs, matches, prefixes = [], [], [], []
            for values in rule.sets(piece):
                n = len(values)
                n_all.append(n)
                with np.errstate(over="ignore"):
                    sig = np.array(
                        [values.sum(dtype=np.uint64), mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)], np.uint64
                    )
                sigs.append(sig.tobytes())
                if n == 0:
                    matches.append(0)
                    prefixes.append(np.zeros(0, np.int64))
                    continue
                near = np.searchsorted(often, values)
                held = np.where(often[near] == values, counts[near], 0)
                order = np.argsort(np.log2(1 + held).astype(np.int8), kind="stable")
                base = n - int(rule.needed(n))
                want = _choose(np.maximum(held[order], _ELSEWHERE), n, base)
                matches.append(want)
                prefixes.append(values[order[: base + want]].view(np.int64))
            first = np.zeros(len(prefixes) + 1, np.int32)
            np.cumsum([len(p) for p in prefixes], out=first[1:])
            yield {
                "doc_id": piece.column("doc_id"), "n": pa.array(n_all, pa.int64()), "sig": pa.array(sigs, pa.binary()),
                "matches": pa.array(matches, pa.int32()),
                "prefix": pa.ListArray.from_arrays(pa.array(first), pa.array(np.concatenate(prefixes), pa.int64())),
            }

        return compute

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_rows(rows, make, "doc_id long, n long, sig binary, matches int, prefix array<long>")


def _shingle_table(docs: DataFrame, needed: DataFrame, rule: Rule) -> DataFrame:
    """(node, shingles) of the documents in ``needed`` and of few others: a Bloom filter spares most texts."""
    bits, probes = bloom.shape(needed.count(), 0.01)
    words = docs.sparkSession.sparkContext.broadcast(bloom.build(needed.select(*bloom.hashes("node")), bits, probes))

    def make():
        def compute(piece):
            h1, h2 = piece.column("h1").to_numpy(), piece.column("h2").to_numpy()
            piece = piece.filter(pa.array(bloom.probe(words.value, probes, h1, h2)))
            if piece.num_rows == 0:
                return
            sets = rule.sets(piece)
            first = np.zeros(len(sets) + 1, np.int32)
            np.cumsum([len(s) for s in sets], out=first[1:])
            yield {
                "node": piece.column("node"),
                "shingles": pa.ListArray.from_arrays(pa.array(first), pa.array(np.concatenate(sets).view(np.int64), pa.int64())),
            }

        return compute

    rows = docs.select(F.col("doc_id").cast("long").alias("node"), "text").select("node", "text", *bloom.hashes("node"))
    return map_rows(rows, make, "node long, shingles array<long>")


def _links_in(nodes: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """(i, root) of a spanning forest of the links among ``sets``."""
    sizes = np.array([len(s) for s in sets], np.int64)
    values, where = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = np.bincount(where, minlength=len(values)) > 1
    column = np.cumsum(shared) - 1
    keep = shared[where]
    owner, col = owner[keep], column[where[keep]]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for a in range(0, int(shared.sum()), width):
        i, j = np.searchsorted(col, [a, a + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[i:j], col[i:j] - a] = 1
        both += part @ part.T
    inter = both.astype(np.int64)
    linked = 100 * inter >= percent * (sizes[:, None] + sizes[None, :] - inter)
    np.fill_diagonal(linked, True)
    label = np.arange(len(sets))
    while True:
        new = np.where(linked, label[None, :], len(sets)).min(axis=1)
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(sets)))
    return np.stack([nodes[moved], nodes[label[moved]]], axis=1)


def _verified(blocks: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) within each group (bucket, i, j) of (node, shingles)."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sets = None, [], []

        def result():
            pairs = _links_in(np.array(nodes), sets, percent)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], names=["u", "v"])

        for batch in batches:
            groups = zip(*(batch.column(c).to_pylist() for c in ("bucket", "i", "j")))
            lists = batch.column("shingles")
            values, first = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for r, (group, node) in enumerate(zip(groups, batch.column("node").to_pylist())):
                if group != key:
                    if len(nodes) > 1:
                        yield result()
                    key, nodes, sets = group, [], []
                nodes.append(node)
                sets.append(values[first[r] : first[r + 1]].copy())
        if len(nodes) > 1:
            yield result()

    importable(blocks.sparkSession)
    dealt = blocks.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")
    return dealt.select("bucket", "i", "j", "node", "shingles").mapInArrow(links, "u long, v long")


def _spread(members: DataFrame, percent: int) -> DataFrame:
    """(bucket, i, j, node): members of a bucket that may link by their sizes meet in some pair of blocks.

    Sizes are put in levels so that linked sets are at most one level apart; group k of a
    bucket has the levels k - 1 and k, and is left out if it has none of level k.
    """
    level = F.floor(F.log("n") / -math.log((percent - 1) / 100)).cast("int")
    leveled = members.select("bucket", "node", level.alias("level")).select(
        "bucket", "node", "level", F.explode(F.array("level", F.col("level") + 1)).alias("k")
    )
    sizes = leveled.groupBy("bucket", "k").agg(
        F.count("*").alias("members"), F.max(F.col("k") == F.col("level")).alias("own")
    ).where("members > 1 AND own")
    dealt = leveled.join(sizes.drop("own"), ["bucket", "k"]).withColumn(
        "blocks", F.ceil(F.col("members") / BLOCK_DOCS).cast("int")
    ).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    return dealt.select(
        F.xxhash64("bucket", "k").alias("bucket"), "node", "own",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node")


def _members(classes: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """(bucket, node, n): any two classes that may link share a bucket.

    ``meta`` packs set size, position in the prefix and matches asked for, to keep the sorted rows narrow.
    """
    rows = classes.select("node", "n", "matches", F.posexplode("prefix").alias("at", "shingle")).select(
        "shingle", "node", F.expr("shiftleft(n, 32) + at * 128L + matches").alias("meta")
    )
    counted = rows.withColumn("df", F.count("*").over(Window.partitionBy("shingle"))).where("df > 1")
    n, at, matches = F.expr("shiftright(meta, 32)"), F.expr("shiftright(meta & 4294967295L, 7)"), F.expr("meta & 127L")
    # the least number of matches whose prefix holds this shingle
    level = F.greatest(F.lit(1), at + 1 - (n - F.floor((percent * n + 99) / 100)))
    counted = scratch.keep(counted.select(
        "shingle", "node", n.alias("n"), at.alias("at"), matches.alias("matches"), level.alias("level"), "df"
    ))
    few = counted.where(F.col("df") <= DENSE)
    x, y = few.alias("x"), few.alias("y")
    want = F.least("x.matches", "y.matches")
    pairs = (
        x.join(
            y,
            (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.node") < F.col("y.node"))
            & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
            & (F.greatest("x.level", "y.level") <= want),
        )
        .groupBy(F.col("x.node").alias("x"), F.col("y.node").alias("y"))
        .agg(F.count("*").alias("shared"), F.first(want).alias("want"), F.first("x.n").alias("nx"), F.first("y.n").alias("ny"))
        .where("shared >= want").select("x", "y", "nx", "ny")
    )
    pairs = scratch.keep(pairs)
    # candidates of one group mostly have the same least neighbour and so come together once
    least = (
        pairs.select("x", "y").union(pairs.select("y", "x")).groupBy("x")
        .agg(F.least(F.min("y"), F.first("x")).alias("least"))
    )
    near = pairs.join(least, "x").select(
        F.struct(F.lit(0).alias("kind"), F.col("least").alias("id")).alias("bucket"),
        F.explode(F.array(F.struct(F.col("x").alias("node"), F.col("nx").alias("n")), F.struct(F.col("y").alias("node"), F.col("ny").alias("n")))).alias("e"),
    ).select("bucket", "e.node", "e.n")
    many = counted.where(F.col("df") > DENSE).select("node", "n", "shingle", "at")
    head = many.groupBy("node").agg(F.min_by("shingle", F.struct("at", "shingle")).alias("head"))
    # shingles that occur together share one bucket; any choice is right, this one keeps copies few
    chosen = many.join(head, "node").groupBy("shingle").agg(F.min("head").alias("head"))
    dense = many.join(chosen, "shingle").select(
        F.struct(F.lit(1).alias("kind"), F.col("head").alias("id")).alias("bucket"), "node", "n"
    )
    return near.union(dense).select(F.xxhash64("bucket").alias("bucket"), "node", "n").distinct()


def _links(docs: DataFrame, classes: DataFrame, scratch: Scratch, rule: Rule) -> DataFrame:
    members = scratch.keep(_members(classes, scratch, rule.percent))
    spread = scratch.keep(_spread(members, rule.percent))
    sets = _shingle_table(docs, spread.select("node").distinct(), rule)
    return _verified(spread.join(sets, "node"), rule.percent)


def near_duplicate_groups(docs: DataFrame, scratch: Scratch, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (``doc_id``, ``text``).

    Texts link when the Jaccard similarity of their shingle sets is at least what ``rule`` says.  Texts of
    fewer words than a shingle are one shingle; null, empty and blank texts have none and link with
    nothing (their component is their own id).  Rows of one id count as one document of the
    links; a row whose id is null takes no part and gets a null component.  No rows give no rows.
    """
    known = docs.where("doc_id IS NOT NULL")
    prefixes = scratch.keep(_prefixes(known, scratch, rule))
    filled = prefixes.where("n > 0").groupBy("sig", "n")
    classes = filled.agg(
        F.min("doc_id").alias("node"), F.first("matches").alias("matches"), F.first("prefix").alias("prefix")
    )
    parts = components(_links(known, classes, scratch, rule), scratch)
    roots = filled.agg(F.min("doc_id").alias("node")).join(
        parts.select(F.col("u").alias("node"), "v"), "node", "left"
    ).select("sig", "n", F.coalesce("v", "node").alias("root"))
    members = prefixes.select("doc_id", "n", "sig").join(roots, ["sig", "n"], "left")
    unknown = docs.where("doc_id IS NULL").select(F.lit(None).cast("long").alias("doc_id"), "text")
    return members.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id")
    ).unionByName(
        map_rows(unknown, _count_only(rule), "doc_id long, n_shingles long, component_id long")
    )


def _count_only(rule: Rule):
    def make():
        def compute(piece):
            n = piece.num_rows
            yield {
                "doc_id": pa.nulls(n, pa.int64()), "n_shingles": pa.array([len(s) for s in rule.sets(piece)], pa.int64()),
                "component_id": pa.nulls(n, pa.int64()),
            }

        return compute

    return make


def one_of_each_group(docs: DataFrame, scratch: Scratch, rule: Rule = Rule()) -> DataFrame:
    """``docs`` without near duplicates: of each group the row of the smallest id stays.

    Rows without an id all stay; of several rows with the same id one stays.
    """
    groups = near_duplicate_groups(docs.select("doc_id", "text"), scratch, rule)
    ids = groups.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_gone")).agg(
        F.max(F.col("doc_id") == F.col("component_id")).alias("kept"), F.count("*").alias("rows")
    )
    # most documents stay and most ids are there once: only rows of the other ids move with their texts
    odd = scratch.keep(ids.where("NOT kept OR rows > 1").select("_gone", "kept"))
    near = might_hold(bloom_of(odd, "_gone", width=ODD_BITS), F.col("doc_id").cast("long"), width=ODD_BITS)
    known = docs.where("doc_id IS NOT NULL")
    gone = odd.where("NOT kept").select("_gone")
    looked_up = known.where(near).join(gone, F.col("doc_id") == F.col("_gone"), "left_anti").dropDuplicates(["doc_id"])
    return known.where(~near).unionByName(looked_up).unionByName(docs.where("doc_id IS NULL"))
