"""Benchmark decontamination (operator 9): Wu-Manber search for many word strings.

The alphabet is the word, a block is two words.  A block table says how far the
search may jump: the shift of a block is its distance to the nearest end of any
pattern that holds it, and the full jump otherwise, so most positions are never
looked at.  Where the shift is 0 the block's hash selects the bucket of patterns
with that suffix; their words are compared, by hash and then by the bytes.

The patterns are the benchmark's windows, cut in tasks.  They are read in blocks of about
``BLOCK_WORDS`` words, each a broadcast of bounded size and one more pass over the
texts in the same stage, so a benchmark of any size works.  The documents are
never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.batches import Scratch, append_columns, map_rows, scratch
from starloom.llm.words import LETTERS_AND_DIGITS, Words, mix, words_of

WINDOW = 10
BLOCK_WORDS = 1_000_000
SEGMENT = 256
_TABLE_BITS = 20

RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_hit long"


class WuManber:
    """Matcher for patterns of one length in words."""

    def __init__(self, length: int, patterns: dict[bytes, list[str]]):
        self.length, self.block = length, min(2, length)
        self.texts = list(patterns)
        self.items = [patterns[t] for t in self.texts]
        words = words_of(pa.array([t.decode("utf-8", "surrogatepass") for t in self.texts]), LETTERS_AND_DIGITS)
        rows = words.hashes.reshape(len(self.texts), length)
        suffix = self._blocks(rows, np.full(len(rows), length - 1), np.arange(len(rows)))
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.rows = suffix[order], rows[order]
        self.texts = [self.texts[i] for i in order]
        self.items = [self.items[i] for i in order]
        self.shift = np.full(1 << _TABLE_BITS, length - self.block + 1, np.uint8)
        mask = np.uint64((1 << _TABLE_BITS) - 1)
        for end in range(self.block - 1, length):
            at = (self._blocks(rows, np.full(len(rows), end), np.arange(len(rows))) & mask).astype(np.int64)
            np.minimum.at(self.shift, at, np.uint8(length - 1 - end))

    def _blocks(self, rows: np.ndarray, end: np.ndarray, row: np.ndarray) -> np.ndarray:
        last = rows[row, end]
        with np.errstate(over="ignore"):
            return mix(last) if self.block == 1 else mix(rows[row, end - 1] * np.uint64(3) + last)

    def _at(self, h: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(h[end]) if self.block == 1 else mix(h[end - 1] * np.uint64(3) + h[end])

    def find(self, words: Words) -> Iterator[tuple[int, int]]:
        """(first word, pattern) of every occurrence."""
        begin, stop = words.first[:-1] + self.length - 1, words.first[1:]
        pos, limit = [], []
        for a, b in zip(begin, stop):
            cuts = np.arange(a, b, SEGMENT)
            pos.append(cuts)
            limit.append(np.minimum(cuts + SEGMENT, b))
        if not pos:
            return
        at, end = np.concatenate(pos).astype(np.int64), np.concatenate(limit).astype(np.int64)
        mask = np.uint64((1 << _TABLE_BITS) - 1)
        found, blocks = [], []
        while len(at):
            block = self._at(words.hashes, at)
            shift = self.shift[(block & mask).astype(np.int64)]
            zero = shift == 0
            if zero.any():
                found.append(at[zero])
                blocks.append(block[zero])
            at = at + np.maximum(shift, 1)
            left = at < end
            at, end = at[left], end[left]
        if not found:
            return
        at, block = np.concatenate(found), np.concatenate(blocks)
        low, high = np.searchsorted(self.suffix, block, "left"), np.searchsorted(self.suffix, block, "right")
        count = high - low
        at, low = np.repeat(at, count), np.repeat(low, count)
        step = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        pattern = low + step
        for back in range(self.length):
            same = words.hashes[at - back] == self.rows[pattern, self.length - 1 - back]
            at, pattern = at[same], pattern[same]
        for e, p in zip(at.tolist(), pattern.tolist()):
            first = e - self.length + 1
            if words.text(first, e + 1) == self.texts[p]:
                yield first, p


def windows(benchmark: DataFrame, scratch: Scratch, size: int = WINDOW) -> Iterator[list[tuple[str, bytes]]]:
    """Blocks of (item id, window words joined by a space), each of bounded size.

    Windows are cut in tasks and stored once each; a block is those of one residue of their hash, so the driver
    holds one block at a time.
    """

    def make():
        def cut(piece: pa.RecordBatch) -> Iterator[dict[str, pa.Array]]:
            words = words_of(piece.column("text"), LETTERS_AND_DIGITS)
            items, texts = [], []
            for item, a, b in zip(piece.column("item").to_pylist(), words.first[:-1].tolist(), words.first[1:].tolist()):
                for at in range(a, max(b - size + 1, a + (b > a))):
                    items.append(item)
                    texts.append(words.text(at, min(at + size, b)))
            yield {"item": pa.array(items, pa.string()), "w": pa.array(texts, pa.binary())}

        return cut

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    table = scratch.keep(map_rows(rows, make, "item string, w binary").distinct())
    blocks = max(1, -(-table.count() * size // BLOCK_WORDS))
    for b in range(blocks):
        part = table.where(F.pmod(F.xxhash64("w"), F.lit(blocks)) == b).toArrow()
        yield list(zip(part.column("item").to_pylist(), part.column("w").to_pylist()))


def _matchers(block: list[tuple[str, bytes]]) -> list[WuManber]:
    by_length: dict[int, dict[bytes, list[str]]] = {}
    for item, text in block:
        held = by_length.setdefault(text.count(b" ") + 1, {}).setdefault(text, [])
        if item not in held:
            held.append(item)
    return [WuManber(n, patterns) for n, patterns in sorted(by_length.items())]


def _search(block, last: bool, hits: str, found: str):
    def make():
        matchers = _matchers(block.value)

        def compute(piece: pa.RecordBatch) -> dict[str, pa.Array]:
            words = words_of(piece.column("text"), LETTERS_AND_DIGITS)
            n, known = piece.num_rows, piece.schema.names
            spans = piece.column(hits).to_pylist() if hits in known else [[] for _ in range(n)]
            items = [set(x) for x in piece.column(found).to_pylist()] if found in known else [set() for _ in range(n)]
            for m in matchers:
                places = sorted(m.find(words))
                docs = np.searchsorted(words.first, [a for a, _ in places], "right") - 1
                for (a, p), d in zip(places, docs.tolist()):
                    begin = a - int(words.first[d])
                    held = spans[d]
                    if held and held[-2] <= begin <= held[-1]:  # runs on: one span
                        held[-1] = max(held[-1], begin + m.length)
                    else:
                        held += [begin, begin + m.length]
                    items[d].update(m.items[p])
            if last:
                return _summary(np.diff(words.first), spans, items)
            return {hits: pa.array(spans, pa.list_(pa.int32())), found: pa.array([sorted(x) for x in items], pa.list_(pa.string()))}

        return compute

    return make


def _summary(n_words: np.ndarray, spans: list[list[int]], items: list[set[str]]) -> dict[str, pa.Array]:
    n_hit, longest = [], []
    for flat in spans:
        reach = total = begin = most = 0
        for a, b in sorted(zip(flat[::2], flat[1::2])):
            total += max(0, b - max(a, reach))
            begin = begin if a <= reach else a
            reach = max(reach, b)
            most = max(most, reach - begin)
        n_hit.append(total)
        longest.append(most)
    digest = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]
    return {
        "n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
        "n_items": pa.array([len(x) for x in items], pa.int64()), "items_sha256": pa.array(digest, pa.string()),
        "contaminated": pa.array([h > 0 for h in n_hit], pa.bool_()), "longest_hit": pa.array(longest, pa.int64()),
    }


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (with ``text``) and what of each text occurs in ``benchmark`` (``item_id``, ``text``).

    Adds ``n_words``, ``n_hit`` (words inside an occurrence), ``n_items``, ``items_sha256``,
    ``contaminated`` and ``longest_hit`` (most words hit in a row), replacing columns of these names.  Null and empty texts have no words; an
    empty benchmark marks nothing; benchmark rows of the same id are one item, an id of null
    is the item ``null``; repeated documents are each marked.
    """
    context = docs.sparkSession.sparkContext
    taken = {c.lower() for c in docs.columns}
    hits, found = (next(n for n in (f"{'_' * i}{name}" for i in range(1, 999)) if n not in taken) for name in ("hits", "items"))
    out, held = docs, []
    with scratch(docs.sparkSession) as own:
        for block in windows(benchmark, own, window):
            if held:
                out = append_columns(out, _search(context.broadcast(held), False, hits, found), f"{hits} array<int>, {found} array<string>")
            held = block
    return append_columns(out, _search(context.broadcast(held), True, hits, found), RESULT).drop(hits, found)
