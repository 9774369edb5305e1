"""Words of a batch of texts as 64-bit hashes, computed over the whole byte buffer at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from starloom.llm.batches import offsets_and_bytes

BLOCK = 1 << 18
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_R = 0x9E3779B97F4A7C15
_R_INV = pow(_R, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW = _powers(_R, BLOCK + 1)
_POW_INV = _powers(_R_INV, BLOCK + 1)


def lower_table(is_separator: np.ndarray) -> np.ndarray:
    """Byte map: 0 for separators, A-Z lower-cased, all else as it is."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[is_separator] = 0
    return table


_codes = np.arange(256)
#: Words are runs of anything but blanks (space, tab to carriage return).
BLANK_SEPARATED = lower_table((_codes == 32) | ((_codes >= 9) & (_codes <= 13)))
#: Words are runs of letters, digits and all characters beyond ASCII.
LETTERS_AND_DIGITS = lower_table(
    (_codes <= 0x2F) | ((_codes >= 0x3A) & (_codes <= 0x40)) | ((_codes >= 0x5B) & (_codes <= 0x60))
    | ((_codes >= 0x7B) & (_codes <= 0x7F))
)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of several texts: ``first[i]:first[i + 1]`` are those of text i."""

    data: np.ndarray  # mapped bytes, 0 between words
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def text(self, begin: int, end: int) -> bytes:
        """Words begin to end - 1, joined by one space."""
        return b" ".join(self.data[self.starts[i] : self.ends[i]].tobytes() for i in range(begin, end))

    def owner(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _hash_range(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    base = int(starts[0])
    part = _BYTE[data[base : int(ends[-1])]]
    if len(part) > BLOCK:  # one word longer than a block
        total, done = 0, 0
        while done < len(part):
            bit = part[done : done + BLOCK]
            total += int((bit * _POW[: len(bit)]).sum(dtype=np.uint64)) * pow(_R, done, 1 << 64)
            done += BLOCK
        return np.array([total & ((1 << 64) - 1)], np.uint64)
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(part * _POW[: len(part)], out=sums[1:])
    return (sums[ends - base] - sums[starts - base]) * _POW_INV[starts - base]


def words_of(texts: pa.Array, table: np.ndarray) -> Words:
    """All words of ``texts`` under the byte map ``table``; null and empty texts have none."""
    offsets, raw = offsets_and_bytes(texts)
    data = table[raw]
    inside = data != 0
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            j = max(int(np.searchsorted(ends, starts[i] + BLOCK, "right")), i + 1)
            hashes[i:j] = _hash_range(data, starts[i:j], ends[i:j])
            i = j
        hashes = mix(hashes ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return Words(data, starts, ends, np.searchsorted(starts, offsets, "left"), hashes)


def shingle_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words, and where those of each text begin; shorter texts are one run."""
    h, count = words.hashes, np.diff(words.first)
    runs = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    first = np.zeros(len(runs) + 1, np.int64)
    np.cumsum(runs, out=first[1:])
    out = np.zeros(int(first[-1]), np.uint64)
    with np.errstate(over="ignore"):
        n = len(h) - k + 1
        if n > 0:
            combined = np.zeros(n, np.uint64)
            for j in range(k):
                combined = mix(combined + h[j : j + n] * np.uint64(2 * j + 3))
            long = np.flatnonzero(count >= k)
            if len(long):
                at = np.repeat(words.first[long] - first[long], runs[long])
                where = np.concatenate([np.arange(first[i], first[i + 1]) for i in long])
                out[where] = combined[where + at]
        for i in np.flatnonzero((count > 0) & (count < k)):
            value = np.uint64(count[i])
            for x in h[words.first[i] : words.first[i + 1]]:
                value = mix(np.array([value * np.uint64(31) + x], np.uint64))[0]
            out[first[i]] = value
    return out, first


def distinct_shingles(words: Words, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    values, first = shingle_hashes(words, k)
    return [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:])]
