"""Bloom filters built by Spark aggregates and probed inside tasks."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 27


def hashes(*columns: Column | str, seed: int = 0) -> list[Column]:
    """Two hashes of a key as columns ``h1`` and ``h2``."""
    return [F.xxhash64(F.lit(seed), *columns).alias("h1"), F.xxhash64(F.lit(seed + 1), *columns).alias("h2")]


def shape(keys: int, rate: float, most: int = MAX_BITS) -> tuple[int, int]:
    """Bits and probes for ``keys`` at a false-positive rate, within ``most`` bits (16 MB)."""
    bits = max(1024, math.ceil(max(keys, 1) * -math.log(rate) / math.log(2) ** 2))
    bits = min(most, (bits + 63) // 64 * 64)
    return bits, max(1, min(16, round(bits / max(keys, 1) * math.log(2))))


def _shift(level: int) -> int:
    return level * 5 % 40


def build(keys: DataFrame, bits: int, probes: int, level: int = 0) -> np.ndarray:
    """Filter of the rows of ``keys`` (``h1``, ``h2``) as 64-bit words; at most ``bits`` reach the driver.

    Filters of different ``level`` use other parts of the hashes.
    """
    a, b = (F.pmod(F.shiftright(h, _shift(level)), F.lit(bits)) for h in ("h1", "h2"))
    b = b.bitwiseOR(F.lit(1))
    at = keys.select(F.explode(F.array(*[F.pmod(a + i * b, F.lit(bits)) for i in range(probes)])).alias("at"))
    words = at.groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(at % 64))")).alias("set")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("set").to_numpy().view(np.uint64)
    return out


def probe(words: np.ndarray, probes: int, h1: np.ndarray, h2: np.ndarray, level: int = 0) -> np.ndarray:
    """Whether each key may be in the filter; never false for a key that is."""
    bits = len(words) * 64
    a, b = np.mod(h1 >> _shift(level), bits), np.mod(h2 >> _shift(level), bits) | 1
    found = np.ones(len(h1), bool)
    for i in range(probes):
        at = (a + i * b) % bits
        found &= (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0
    return found
