"""URL filters (operator 6) by a Bloom filter cascade.

A cascade answers "is this key listed?" exactly for every key of a known universe.  Level 0 is a Bloom
filter of the listed keys; level 1 holds the keys of the universe that level 0 takes for listed and
are not; level 2 the listed keys that level 1 takes for those; and so on until no key is mistaken.
A key is looked up level by level; the first level that does not know it decides.

The universe are the distinct keys of the corpus: for each url the host's suffixes joined with the
path prefixes that rules have, and the host itself.  Levels are built by Spark aggregates; each has at most ``bloom.MAX_BITS``
bits, and urls are judged without any join or shuffle.  A list that needs more is cut into shards by a hash, each with a cascade
of its own, so any number of listed keys is answered exactly.  What a task holds is some two bytes a listed key.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm import bloom
from starloom.llm.batches import Scratch, append_columns

_MAX_LEVELS = 64


@dataclass
class Cascade:
    """Bloom filters in order, each with its number of probes."""

    levels: list[tuple[np.ndarray, int]]

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether each key of the universe is listed."""
        out = np.full(len(h1), len(self.levels) % 2 == 1)
        left = np.arange(len(h1))
        for i, (words, probes) in enumerate(self.levels):
            known = bloom.probe(words, probes, h1[left], h2[left], i)
            out[left[~known]] = i % 2 == 1
            left = left[known]
        return out


@dataclass
class Shards:
    """A cascade for each shard of the keys."""

    cascades: list[Cascade]

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether each key of the universe is listed."""
        shard = np.mod(h1 ^ h2, len(self.cascades))
        out = np.zeros(len(h1), bool)
        for i, cascade in enumerate(self.cascades):
            own = np.flatnonzero(shard == i)
            if len(own):
                out[own] = cascade.listed(h1[own], h2[own])
        return out


def _passing(keys: DataFrame, words: np.ndarray, probes: int, level: int) -> DataFrame:
    held = keys.sparkSession.sparkContext.broadcast(words)

    def make():
        def compute(piece):
            found = bloom.probe(held.value, probes, piece.column("h1").to_numpy(), piece.column("h2").to_numpy(), level)
            return {"known": pa.array(found)}

        return compute

    return append_columns(keys, make, "known boolean", text=None).where("known").drop("known")


def build_cascade(universe: DataFrame, listed: DataFrame, scratch: Scratch) -> Cascade | Shards:
    """Cascade for the distinct keys of ``universe`` (``key``), of which those in ``listed`` (``key``) are listed.

    Null keys take no part.  Without listed keys nothing is listed.  Shards if one filter can't hold the listed keys.
    """
    marked = universe.select("key").where("key IS NOT NULL").distinct().join(
        listed.select("key").where("key IS NOT NULL").distinct().withColumn("listed", F.lit(True)), "key", "left"
    )
    table = scratch.keep(marked.select(*bloom.hashes("key"), F.coalesce("listed", F.lit(False)).alias("listed")))
    n, others = table.where("listed").count(), table.where("NOT listed").count()
    needed, _ = bloom.shape(n, _rate(n, others), 1 << 62)
    if needed <= bloom.MAX_BITS:
        return _cascade(table, scratch)
    # a tenth more, as shards are not equally large
    shards = -(-needed * 11 // (10 * bloom.MAX_BITS))
    dealt = scratch.keep(table.withColumn("shard", F.pmod(F.col("h1").bitwiseXOR(F.col("h2")), F.lit(shards))), "shard")
    return Shards([_cascade(dealt.where(F.col("shard") == i).drop("shard"), scratch) for i in range(shards)])


def _rate(listed: int, others: int) -> float:
    """False positives of the first level that keep all levels together small."""
    return min(0.5, max(1e-6, listed / (1.42 * max(others, 1))))


def _cascade(table: DataFrame, scratch: Scratch) -> Cascade:
    inside, outside = table.where("listed").drop("listed"), table.where("NOT listed").drop("listed")
    n, others = inside.count(), outside.count()
    levels: list[tuple[np.ndarray, int]] = []
    rate = _rate(n, others)
    while n:
        if len(levels) == _MAX_LEVELS:
            raise RuntimeError("two keys have the same hashes")
        bits, probes = bloom.shape(n, rate)
        words = bloom.build(inside, bits, probes, len(levels))
        wrong = scratch.keep(_passing(outside, words, probes, len(levels)))
        levels.append((words, probes))
        inside, outside, n, rate = wrong, inside, wrong.count(), 0.5
    return Cascade(levels)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null and where there is no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    before = F.regexp_extract(rest, r"(?s)^[^?#]*", 0)
    host = F.translate(F.regexp_extract(before, r"(?s)^[^/]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(before, r"(?s)^[^/]*+(.*)$", 1)
    return host, path


def _suffixes(host: Column, labels: int) -> Column:
    """The host's last 1 to ``labels`` labels, as far as it has that many, longest first."""
    parts = F.split(host, r"\.", -1)
    lengths = F.sequence(F.least(F.size(parts), F.lit(labels)), F.lit(1))
    return F.transform(lengths, lambda n: F.array_join(F.slice(parts, -n, n), "."))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame, scratch: Scratch) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` of its ``url``, replacing columns of these names.

    ``rules``: (allow or block, host, path); a rule fits its host and all subdomains if the path begins with
    the rule's, and the longest host, then path, wins.  Urls without a rule are blocked if ``listed``
    (``key``) has their host, else allowed.  A null or broken url has an empty host and path,
    fits no rule and is allowed unless the empty host is listed.
    """
    names = {"host", "path", "rule", "verdict"}
    taken = {c.lower() for c in pages.columns}
    # state under names that no column has
    mark = next(m for m in ("_" * i for i in range(1, 1000)) if not taken & {f"{m}keys", f"{m}h1", f"{m}h2"})
    own_keys, first, second = f"{mark}keys", f"{mark}h1", f"{mark}h2"
    host, path = host_and_path()
    rows = pages.select([c for c in pages.columns if c.lower() not in names]).withColumns({"host": host, "path": path})
    widths = sorted({len(p) for _, _, p in rules}, reverse=True)
    deep = max([h.count(".") + 1 for _, h, _ in rules], default=1)

    def prefixes(suffix: Column) -> Column:
        fits = [F.when(F.length("path") >= w, F.concat(suffix, F.substring("path", 1, w))) for w in widths]
        return F.filter(F.array(*fits), lambda x: x.isNotNull()) if fits else F.array().cast("array<string>")

    # the host itself is last, told from the rules' keys by a mark that no url's host has
    keys = F.concat(
        F.flatten(F.transform(_suffixes(F.col("host"), deep), prefixes)), F.array(F.concat(F.lit("://"), F.col("host")))
    )
    keyed = rows.withColumn(own_keys, keys)
    universe = keyed.select(F.explode(own_keys).alias("key")).distinct()
    spark = pages.sparkSession
    allow = spark.createDataFrame([(h + p,) for v, h, p in rules if v == "allow"], "key string")
    block = spark.createDataFrame([(h + p,) for v, h, p in rules if v == "block"], "key string")
    hosts = listed.select(F.concat(F.lit("://"), F.col("key")).alias("key"))
    universe = scratch.keep(universe)
    lists = [build_cascade(universe, x, scratch) for x in (allow, block, hosts)]
    scratch.remove()
    held = spark.sparkContext.broadcast(lists)
    hashed = keyed.withColumns({
        first: F.transform(own_keys, lambda k: F.xxhash64(F.lit(0), k)), second: F.transform(own_keys, lambda k: F.xxhash64(F.lit(1), k)),
    })

    def make():
        allowed, blocked, hosts = held.value

        def compute(piece):
            keys = piece.column(own_keys)
            begin = keys.offsets.to_numpy() - keys.offsets[0].as_py()
            last = begin[1:] - 1  # the host; every row has one
            h1, h2 = (piece.column(c).flatten().to_numpy() for c in (first, second))
            may, must, bad = (x.listed(h1, h2) for x in (allowed, blocked, hosts))
            fits = may | must
            fits[last] = False
            hits = np.append(np.flatnonzero(fits), len(fits))
            hit = hits[np.searchsorted(hits, begin[:-1])]  # the first rule of each row, or one of a later row
            found = hit < last
            hit = np.where(found, hit, 0)
            wrong = np.where(found, must[hit], bad[last])
            return {
                "rule": keys.flatten().take(pa.array(hit, mask=~found)).cast(pa.string()),
                "verdict": pa.array(np.where(wrong, "block", "allow").tolist(), pa.string()),
            }

        return compute

    return append_columns(hashed, make, "rule string, verdict string", text=None).drop(own_keys, first, second)
