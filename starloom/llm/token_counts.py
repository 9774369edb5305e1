"""Token counts (operator 3): edit-aware counting with a segment tree of pre-tokens for each document.

A text is cut into pre-tokens by the tokenizer's pattern.  Leaves of the tree are runs of ``LEAF``
pre-tokens with their lengths and token counts; each node holds the characters and the tokens below it.
An edit descends by characters to the first pre-token it can touch (two characters of context before it, as far as
the pattern ever looks ahead), cuts and encodes the new text from there until a boundary falls on an old one behind the
edit, and adjusts the sums above the leaves it changed.  Everything else stays as it is.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.batches import append_columns, append_steps

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF = 32
CONTEXT = 2
REMEMBERED = 300_000
TREE = "lengths array<int>, counts array<int>, leaves array<int>, tree_chars array<long>, tree_tokens array<long>"
EDITED = "tokens_before long, tokens_after long, n_edits long, reencoded long"


class Counter(dict):
    """Token count of a pre-token; remembers up to ``REMEMBERED`` of them."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.encoding = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cut = regex.compile(PATTERN)

    def __missing__(self, piece: str) -> int:
        n = len(self.encoding.encode_ordinary(piece))
        if len(piece) < 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n

    def whole(self, text: str) -> int:
        return sum(map(self.__getitem__, self.cut.findall(text)))


class Tree:
    """Segment tree over leaves of (lengths, counts) of pre-tokens."""

    def __init__(self, lengths: np.ndarray, counts: np.ndarray, leaves: np.ndarray | None = None):
        if leaves is None:
            leaves = np.full(-(-len(lengths) // LEAF), LEAF)
            if len(leaves):
                leaves[-1] = len(lengths) - LEAF * (len(leaves) - 1)
        ends = np.cumsum(leaves)
        self.leaves = [(lengths[b - n : b], counts[b - n : b]) for n, b in zip(leaves, ends)]
        self.width = 1 << max(0, (len(self.leaves) - 1).bit_length())
        self.chars, self.tokens = np.zeros(2 * self.width, np.int64), np.zeros(2 * self.width, np.int64)
        if len(leaves):
            first = ends - leaves
            some = np.flatnonzero(leaves)
            if len(some):
                self.chars[self.width + some] = np.add.reduceat(lengths, first[some])
                self.tokens[self.width + some] = np.add.reduceat(counts, first[some])
        level = self.width
        while level > 1:
            for sums in (self.chars, self.tokens):
                sums[level // 2 : level] = sums[level : 2 * level].reshape(-1, 2).sum(axis=1)
            level //= 2

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def at(self, place: int) -> tuple[int, int, int]:
        """Leaf, index in it and begin of the pre-token that holds the character ``place``, else of the last one."""
        node, begin = 1, 0
        place = min(place, int(self.chars[1]) - 1)
        while node < self.width:
            left = int(self.chars[2 * node])
            node = 2 * node if place < begin + left else 2 * node + 1
            begin += left if node & 1 else 0
        lengths = self.leaves[node - self.width][0]
        ends = begin + np.cumsum(lengths)
        i = int(np.searchsorted(ends, place, "right"))
        return node - self.width, i, int(ends[i] - lengths[i])

    def put(self, leaf: int, lengths: np.ndarray, counts: np.ndarray) -> None:
        """Replace a leaf and adjust the sums above it."""
        self.leaves[leaf] = (lengths, counts)
        node = self.width + leaf
        chars, tokens = int(lengths.sum()) - int(self.chars[node]), int(counts.sum()) - int(self.tokens[node])
        while node:
            self.chars[node] += chars
            self.tokens[node] += tokens
            node //= 2


def build(text: str, counter: Counter) -> Tree:
    pieces = counter.cut.findall(text)
    return Tree(np.fromiter(map(len, pieces), np.int64, len(pieces)), np.fromiter(map(counter.__getitem__, pieces), np.int64, len(pieces)))


def edit(text: str, tree: Tree, start: int, end: int, new: str, counter: Counter) -> tuple[str, Tree, int]:
    """Text and tree after ``text[start:end] = new``, and how many pre-tokens were encoded."""
    start = max(0, min(start, len(text)))
    end = max(start, min(end, len(text)))
    changed = text[:start] + new + text[end:]
    if not tree.leaves or not text:
        tree = build(changed, counter)
        return changed, tree, sum(len(x[0]) for x in tree.leaves)
    leaf, i, begin = tree.at(max(0, start - CONTEXT))
    shift = len(changed) - len(text)
    last, j, old = leaf, i, begin  # the old boundary next to be met
    lengths, counts = [], []
    at = begin

    def old_up_to(place: int) -> bool:
        """Move on to the first old boundary at or behind ``place``; whether it is there."""
        nonlocal last, j, old
        while old < place and last < len(tree.leaves):
            own = tree.leaves[last][0]
            while j < len(own) and old < place:
                old += int(own[j])
                j += 1
            if j == len(own):
                last, j = last + 1, 0
        return old == place

    met = False
    for match in counter.cut.finditer(changed, begin):
        if match.start() >= start + len(new) and match.start() - shift >= end and old_up_to(match.start() - shift):
            met = True
            break
        lengths.append(match.end() - match.start())
        counts.append(counter[match[0]])
        at = match.end()
    if not met:
        last, j = len(tree.leaves), 0
    left = tree.leaves[leaf]
    right = tree.leaves[last] if last < len(tree.leaves) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    merged = [np.concatenate([left[k][:i], np.array((lengths, counts)[k], np.int64), right[k][j:]]) for k in (0, 1)]
    for empty in range(leaf + 1, min(last + 1, len(tree.leaves))):
        tree.put(empty, np.zeros(0, np.int64), np.zeros(0, np.int64))
    tree.put(leaf, *merged)
    if len(merged[0]) > 8 * LEAF:  # keep leaves short
        tree = Tree(*(np.concatenate([x[k] for x in tree.leaves]) for k in (0, 1)))
    return changed, tree, len(lengths)


_COUNTERS: dict[int, Counter] = {}


def _counter(docs: DataFrame, path: str) -> Callable[[], Counter]:
    with open(path, "rb") as file:  # a parameter of the driver; tasks get it as a broadcast of some megabytes
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    held = docs.sparkSession.sparkContext.broadcast(ranks)

    def counter() -> Counter:
        """One for each worker and vocabulary."""
        key = id(held.value)
        if key not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[key] = Counter(held.value)
        return _COUNTERS[key]

    return counter


def _column(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    first = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=first[1:])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(first), pa.array(flat).cast(kind))


def build_trees(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """``docs`` with the tree of its ``text`` as columns (null and empty texts: an empty tree), replacing columns of these names."""
    return append_columns(docs, *_building(_counter(docs, path)))


def _building(counter: Callable[[], Counter]):
    def make():
        own = counter()

        def compute(piece):
            trees = [build(t or "", own) for t in piece.column("text").to_pylist()]
            none = [np.zeros(0, np.int64)]
            return {
                "lengths": _column([np.concatenate(none + [x[0] for x in t.leaves]) for t in trees], pa.int32()),
                "counts": _column([np.concatenate(none + [x[1] for x in t.leaves]) for t in trees], pa.int32()),
                "leaves": _column([np.array([len(x[0]) for x in t.leaves], np.int64) for t in trees], pa.int32()),
                "tree_chars": _column([t.chars for t in trees], pa.int64()), "tree_tokens": _column([t.tokens for t in trees], pa.int64()),
            }

        return compute

    return make, TREE


def apply_edits(trees: DataFrame, path: str = RANKS) -> DataFrame:
    """``trees`` after its ``edits`` (array of struct start, end, new), each on the text that those before it left.

    ``text`` and the tree's columns become those of the edited text; adds token counts before and
    after, the number of edits and of pre-tokens encoded again.  Places beyond the text are moved to
    its end; null edits are none; null texts count as empty and stay null without edits.
    """
    return append_columns(trees, *_editing(_counter(trees, path)))


def counted_through_edits(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """:func:`build_trees` of ``docs``, then :func:`apply_edits` of its ``edits``, in one pass."""
    counter = _counter(docs, path)
    (build_step, tree), (edit_step, _) = _building(counter), _editing(counter)
    return append_steps(docs, [(build_step, f"text string, {tree}"), (edit_step, EDITED)])


def _editing(counter: Callable[[], Counter]):
    def make():
        own = counter()

        def compute(piece):
            texts, out, changed = piece.column("text").to_pylist(), [], []
            lengths, counts, leaves = (piece.column(c) for c in ("lengths", "counts", "leaves"))
            for i, edits in enumerate(piece.column("edits").to_pylist()):
                values = [np.asarray(c[i].values).astype(np.int64) for c in (lengths, counts, leaves)]
                tree, text, again = Tree(*values), texts[i], 0
                before = tree.total
                for e in edits or []:
                    text, tree, n = edit(text or "", tree, e["start"], e["end"], e["new"] or "", own)
                    again += n
                out.append((before, tree.total, len(edits or []), again))
                changed.append((text, tree))
            none = [np.zeros(0, np.int64)]
            trees = [t for _, t in changed]
            return {
                "text": pa.array([t for t, _ in changed], pa.string()),
                "lengths": _column([np.concatenate(none + [x[0] for x in t.leaves]) for t in trees], pa.int32()),
                "counts": _column([np.concatenate(none + [x[1] for x in t.leaves]) for t in trees], pa.int32()),
                "leaves": _column([np.array([len(x[0]) for x in t.leaves], np.int64) for t in trees], pa.int32()),
                "tree_chars": _column([t.chars for t in trees], pa.int64()), "tree_tokens": _column([t.tokens for t in trees], pa.int64()),
            } | {n: pa.array([r[k] for r in out], pa.int64()) for k, n in enumerate(("tokens_before", "tokens_after", "n_edits", "reencoded"))}

        return compute

    return make, f"text string, {TREE}, {EDITED}"


_REDACTED = regex.compile(r"(?P<mail>[^\s@]{1,64}+@[^\s@]++)|(?P<number>[0-9]{5,}+)")
_NUMBER = re.compile(r"[0-9]{5,}")


def _places(text: str) -> list[tuple[int, int, str]]:
    """Addresses and numbers in order; a text without an @ has no address, which spares trying one at every character."""
    if "@" not in text:
        return [(*m.span(), "<NUMBER>") for m in _NUMBER.finditer(text)]
    return [(*m.span(), "<MAIL>" if m["mail"] else "<NUMBER>") for m in _REDACTED.finditer(text)]


def redactions(docs: DataFrame) -> DataFrame:
    """``docs`` with ``edits``: addresses become <MAIL> and numbers of five digits or more <NUMBER>, from the last to the first."""

    def make():
        def compute(piece):
            rows = [
                [{"start": start, "end": end, "new": new} for start, end, new in _places(t or "")][::-1]
                for t in piece.column("text").to_pylist()
            ]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("new", pa.string())]))
            return {"edits": pa.array(rows, kind)}

        return compute

    return append_columns(docs, make, "edits array<struct<start:int,end:int,new:string>>")
