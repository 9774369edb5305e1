"""SentencePiece encoding and decoding (operator 8).

An Aho-Corasick automaton over all pieces reads a text once.  At each position its output links give the
pieces that end there, and each relaxes the best score of that position: a Viterbi search in a single pass.
The segmentation maximises the sum of the piece scores of the model file; a character without a piece
costs more than the worst of them and becomes byte pieces.  Ties go to the longer last piece.  A file
of kind BPE is read as a table of scored pieces, so ids are those of unigram encoding over that table.

Where no piece goes on after an inner word mark, the best segmentation of a text is that of
its words side by side; each distinct word of a batch is then encoded once, all of them in step.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starloom.llm.batches import append_columns, append_steps, offsets_and_bytes
from starloom.llm.words import mix, words_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
_LOCKSTEP = 200  # longer words are taken alone
_BLANKS = np.where(np.arange(256) == 32, 0, np.arange(256)).astype(np.uint8)
_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6
ENCODED = "ids array<int>"
DECODED = "decoded string"
DIGESTED = "n_pieces long, ids_sha256 string"


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 == 2:
            size = varint()
            yield key >> 3, data[at : at + size]
            at += size
        else:
            size = 4 if key & 7 == 5 else 8
            yield key >> 3, data[at : at + size]
            at += size


def read_model(data: bytes) -> dict:
    """Pieces with scores and kinds, and the normaliser's settings, of a model file."""
    pieces, prefix, shrink, rewrites = [], True, True, b""
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            pieces.append((own[1].decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, _NORMAL)))
        elif number == 3:
            own = dict(_fields(value))
            prefix, shrink, rewrites = bool(own.get(3, 1)), bool(own.get(4, 1)), own.get(2, b"")
    if shrink or rewrites:
        raise ValueError("only models without text normalisation are read, as encoding must be reversible")
    return {"pieces": pieces, "prefix": prefix}


class ByteAutomaton:
    """Aho-Corasick automaton over byte strings in arrays: state 0 is the root, ``follow`` has every step resolved.

    ``first`` is the nearest state, from a state itself down its suffixes, where a string ends (0: none), ``next`` the one
    after that; ``piece``, ``size`` and ``score`` describe the string that ends in a state.  About 100 MB for 32,000 pieces.
    """

    def __init__(self, strings: list[tuple[bytes, int, float]]):
        used = sorted({b for text, _, _ in strings for b in text})
        self.column = np.zeros(256, np.int64)  # column 0: bytes of no string
        self.column[used] = np.arange(1, len(used) + 1)
        children: list[dict[int, int]] = [{}]
        ends: dict[int, tuple[int, int, float]] = {}
        for text, piece, score in strings:
            state = 0
            for b in text:
                following = children[state].get(b)
                if following is None:
                    following = children[state][b] = len(children)
                    children.append({})
                state = following
            ends[state] = (piece, len(text), score)
        n = len(children)
        self.follow = np.zeros((n, len(used) + 1), np.int32)
        self.piece, self.size, self.score = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
        for state, (piece, size, score) in ends.items():
            self.piece[state], self.size[state], self.score[state] = piece, size, score
        self.first, self.next = np.zeros(n, np.int64), np.zeros(n, np.int64)
        suffix, layer = [0] * n, [0]
        column = self.column.tolist()
        while layer:  # shorter strings first: a state's suffix is complete before the state
            below = []
            for state in layer:
                back = suffix[state]
                if state:
                    self.follow[state] = self.follow[back]
                    self.next[state] = self.first[back]
                    self.first[state] = state if state in ends else self.first[back]
                for b, child in children[state].items():
                    suffix[child] = int(self.follow[back, column[b]]) if state else 0
                    self.follow[state, column[b]] = child
                    below.append(child)
            layer = below


class Coder:
    """Encoder and decoder of one model."""

    def __init__(self, model: dict):
        self.prefix = model["prefix"]
        pieces = model["pieces"]
        plain = [(t, s, i) for i, (t, s, kind) in enumerate(pieces) if kind in (_NORMAL, _USER)]
        self.automaton = ahocorasick.Automaton()
        for text, score, i in plain:
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self._links = [(len(t), s) for t, s, _ in pieces]
        self.single = {t for t, _, _ in plain if len(t) == 1}
        self.unknown_score = min(s for _, s, _ in plain) - 10
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == _UNKNOWN), 0)
        self.byte = {int(t[3:5], 16): i for i, (t, _, kind) in enumerate(pieces) if kind == _BYTE}
        self.bytes_of = [
            bytes([int(t[3:5], 16)]) if kind == _BYTE else t.replace(MARK, " ").encode() if kind in (_NORMAL, _USER) else b""
            for t, _, kind in pieces
        ]
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}|[ \0]", t) for t, _, _ in plain)
        self.by_byte = ByteAutomaton([(t.replace(MARK, " ").encode(), i, s) for t, s, i in plain] if self.by_word else [])
        self.covered = np.zeros(0x110000, bool)  # characters that are pieces
        self.covered[[ord(" " if c == MARK else c) for c in self.single]] = True
        self.byte_ids = np.array([self.byte.get(b, self.unknown) for b in range(256)], np.int64)
        self.table = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.table_sizes = np.array([len(x) for x in self.bytes_of], np.int64)

    def best(self, text: str) -> list[int]:
        """Ids of the best segmentation of ``text``, in which blanks are marks."""
        n = len(text)
        score, came = [0.0] + [-np.inf] * n, [-1] * (n + 1)
        done = n if self.single.issuperset(text) else 0  # up to here characters without a piece are relaxed

        def unknown_until(end: int) -> None:
            nonlocal done
            while done < end:
                if text[done] not in self.single and score[done] + self.unknown_score > score[done + 1]:
                    score[done + 1] = score[done] + self.unknown_score
                done += 1

        for last, i in self.automaton.iter(text):
            end = last + 1
            if done < end:
                unknown_until(end)
            length, value = self._links[i]
            candidate = score[end - length] + value
            if candidate > score[end]:
                score[end], came[end] = candidate, i
        unknown_until(n)
        ids: list[int] = []
        while n:
            i = came[n]
            if i >= 0:
                ids.append(i)
            elif self.byte:
                ids += [self.byte[b] for b in reversed(text[n - 1].encode("utf-8", "surrogatepass"))]
            else:
                ids.append(self.unknown)
            n -= self._links[i][0] if i >= 0 else 1
        return ids[::-1]

    def best_of(self, text: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`best` of many short words (UTF-8, blanks as marks, a zero byte after each): ids of all, and how many each has.

        All words walk through the automaton side by side, a byte at a time; at each position the output links
        are followed for all of them and relax the best scores there, the longest piece first.
        """
        automaton = self.by_byte
        starts = np.cumsum(sizes + 1) - sizes - 1
        score = np.full(len(text) + 1, -np.inf)
        came, length = np.full(len(text) + 1, self.unknown), np.zeros(len(text) + 1, np.int64)
        score[starts] = 0.0
        # characters without a piece, and the pieces of their bytes
        heads = np.flatnonzero((text & 0xC0) != 0x80)
        points = np.frombuffer(text.tobytes().decode().encode("utf-32-le"), np.uint32)
        widths = np.diff(np.append(heads, len(text)))
        odd = ~self.covered[points] & (points > 0)
        lone = np.zeros(len(text) + 1, np.int64)  # at the end of such a character, its width
        lone[heads[odd] + widths[odd]] = widths[odd]
        if self.byte:
            inside = np.flatnonzero(np.repeat(odd, widths))
            came[inside + 1], length[inside + 1] = self.byte_ids[text[inside]], 1
        else:
            length[heads[odd] + widths[odd]] = widths[odd]

        order = np.argsort(-sizes, kind="stable")
        begin, state = starts[order], np.zeros(len(sizes), np.int64)
        going = np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0))), "left")
        for level, n in enumerate(going.tolist()):
            at = begin[:n] + level + 1
            state[:n] = automaton.follow[state[:n], automaton.column[text[at - 1]]]
            best = np.where(lone[at] > 0, score[at - lone[at]] + self.unknown_score, -np.inf)
            link = automaton.first[state[:n]]
            on = np.flatnonzero(link > 0)
            link = link[on]
            while len(on):
                candidate = score[at[on] - automaton.size[link]] + automaton.score[link]
                better = candidate > best[on]
                won, by = on[better], link[better]
                best[won] = candidate[better]
                came[at[won]], length[at[won]] = automaton.piece[by], automaton.size[by]
                link = automaton.next[link]
                on, link = on[link > 0], link[link > 0]
            score[at] = best
        rows = np.flatnonzero(sizes > 0)
        at = (starts + sizes)[rows]
        ids, own = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(at):
            ids.append(came[at])
            own.append(rows)
            at = at - length[at]
            more = at > starts[rows]
            at, rows = at[more], rows[more]
        own, ids = np.concatenate(own)[::-1], np.concatenate(ids)[::-1]
        return ids[np.argsort(own, kind="stable")].astype(np.int32), np.bincount(own, minlength=len(sizes))

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text, without the words of a batch."""
        if not text:
            return np.zeros(0, np.int32)
        text = (MARK if self.prefix else "") + text.replace(" ", MARK)
        return np.array(self.best(text), np.int32)

    def encode_batch(self, texts: pa.Array) -> pa.Array:
        """Ids of each text as a list array.

        Each distinct word of the batch, with the blanks before it, is encoded once; its ids are gathered wherever it occurs.
        Words of a batch are told apart by 64-bit hashes.
        """
        offsets, raw = offsets_and_bytes(texts)
        marked = raw[:-2][(raw[:-2] == 0xE2) & (raw[1:-1] == 0x96) & (raw[2:] == 0x81)] if len(raw) > 2 else raw[:0]
        if not self.by_word or len(marked) or (raw == 0).any():
            return pa.array([None if t is None else self.encode(t) for t in texts.to_pylist()], pa.list_(pa.int32()))
        if self.prefix:
            filled = np.diff(offsets) > 0
            raw = np.insert(raw, offsets[:-1][filled], 32)
            offsets = offsets + np.concatenate([[0], np.cumsum(filled)])
        words = words_of(pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(raw)), _BLANKS)
        starts, ends, first, keys = words.starts, words.ends, words.first, words.hashes
        begin = np.empty_like(starts)  # of the blanks before each word
        begin[1:] = ends[:-1]
        has = np.diff(first) > 0
        begin[first[:-1][has]] = offsets[:-1][has]
        with np.errstate(over="ignore"):
            keys = mix(keys + (starts - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        # blanks that end a text are words of their own
        after = offsets[:-1].copy()
        after[has] = ends[first[1:][has] - 1]
        tail = np.flatnonzero(after < offsets[1:])
        if len(tail):
            at = first[1:][tail]
            blank = mix((offsets[1:] - after)[tail].astype(np.uint64) ^ np.uint64(0xD1B54A32D192ED03))
            keys, begin, ends = np.insert(keys, at, blank), np.insert(begin, at, after[tail]), np.insert(ends, at, offsets[1:][tail])
            first = first + np.concatenate([[0], np.cumsum(np.isin(np.arange(len(texts)), tail))])
        _, where, which = np.unique(keys, return_index=True, return_inverse=True)
        begin, sizes = begin[where], (ends - begin)[where]
        short = np.flatnonzero(sizes <= _LOCKSTEP)
        long = np.flatnonzero(sizes > _LOCKSTEP)
        step = np.arange(int(sizes[short].sum())) - np.repeat(np.cumsum(sizes[short]) - sizes[short], sizes[short])
        gap = np.repeat(np.arange(len(short)), sizes[short])
        text = np.zeros(len(step) + len(short), np.uint8)
        text[np.arange(len(step)) + gap] = raw[np.repeat(begin[short], sizes[short]) + step]
        ids, counts = self.best_of(text, sizes[short])
        alone = [self.best(raw[b : b + n].tobytes().decode().replace(" ", MARK)) for b, n in zip(begin[long], sizes[long])]
        ids = np.concatenate([ids, *[np.array(x, np.int32) for x in alone]])
        counts = np.concatenate([counts, np.array([len(x) for x in alone], np.int64)])
        place = np.empty(len(sizes), np.int64)
        place[short], place[long] = np.arange(len(short)), len(short) + np.arange(len(long))
        values, offset = _gathered(ids, counts, place[which])
        rows = pa.array(offset[first].astype(np.int32), pa.int32())
        return pa.ListArray.from_arrays(rows, pa.array(values), mask=texts.is_null() if texts.null_count else None)

    def decode(self, ids: list[int]) -> str:
        return self.decode_batch(pa.array([ids], pa.list_(pa.int32())))[0].as_py()

    def decode_batch(self, column: pa.Array) -> pa.Array:
        """Text of each list of ids: the bytes of all pieces in one gather from a flat table."""
        bounds = column.offsets.to_numpy()
        ids = column.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]]
        data, offset = _gathered(self.table, self.table_sizes, ids)
        rows = offset[bounds - bounds[0]]
        if self.prefix and len(data):  # the blank that encoding put before a text
            filled = rows[:-1] < rows[1:]
            cut = filled & (data[np.minimum(rows[:-1], len(data) - 1)] == 32)
            data = np.delete(data, rows[:-1][cut])
            rows = rows - np.concatenate([[0], np.cumsum(cut)])
        heads = rows[:-1][rows[:-1] < len(data)]
        try:
            data.tobytes().decode("utf-8")
            whole = not ((data[heads] & 0xC0) == 0x80).any()
        except UnicodeDecodeError:
            whole = False
        missing = column.is_null().to_pylist() if column.null_count else None
        if whole and missing is None:
            return pa.LargeStringArray.from_buffers(len(rows) - 1, pa.py_buffer(rows), pa.py_buffer(data)).cast(pa.string())
        parts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(rows[:-1], rows[1:])]
        return pa.array([None if missing and missing[i] else t for i, t in enumerate(parts)], pa.string())


def _gathered(values: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``values`` (of ``sizes``, one after another) chosen by ``which``: all together, and their offsets."""
    begin = np.cumsum(sizes) - sizes
    lengths = sizes[which]
    offset = np.zeros(len(which) + 1, np.int64)
    np.cumsum(lengths, out=offset[1:])
    at = np.arange(int(offset[-1])) + np.repeat(begin[which] - offset[:-1], lengths)
    return values[at], offset


def _coder(docs: DataFrame, path: str):
    with open(path, "rb") as file:  # a parameter of the driver; tasks get it as a broadcast of under a megabyte
        return docs.sparkSession.sparkContext.broadcast(read_model(file.read()))


def _encoding(model):
    def make():
        coder = _shared(model)

        def compute(piece):
            return {"ids": coder.encode_batch(piece.column("text"))}

        return compute

    return make, ENCODED


def _decoding(model):
    def make():
        coder = _shared(model)

        def compute(piece):
            return {"decoded": coder.decode_batch(piece.column("ids"))}

        return compute

    return make, DECODED


def _id_rows(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The ids of each row as an array, without a Python number for each."""
    values, first = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for valid, a, b in zip(column.is_valid().to_pylist(), first[:-1], first[1:]):
        yield values[a:b] if valid else None


def _digesting():
    def compute(piece):
        rows = [np.zeros(0, "<i4") if x is None else x.astype("<i4") for x in _id_rows(piece.column("ids"))]
        return {
            "n_pieces": pa.array([len(x) for x in rows], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in rows], pa.string()),
        }

    return compute


_CODERS: dict[int, Coder] = {}


def _shared(model) -> Coder:
    """One coder for each worker and model."""
    key = id(model.value)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(model.value)
    return _CODERS[key]


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``docs`` with ``ids`` of its ``text``: null for null, empty for empty; a column of this name is replaced."""
    return append_columns(docs, *_encoding(_coder(docs, path)))


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids``: null for null.

    Equal to the text that was encoded, but for U+2581, which decodes as a blank.
    """
    return append_columns(encoded, *_decoding(_coder(encoded, path)), text="text" if "text" in encoded.columns else None)


def digest(encoded: DataFrame) -> DataFrame:
    """``encoded`` with ``n_pieces`` and ``ids_sha256``, the digest of the ids as little-endian 32-bit numbers (null ids: as none)."""
    return append_columns(encoded, lambda: _digesting(), DIGESTED, text=None)


def coded(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """:func:`encode`, :func:`decode` and :func:`digest` in one pass."""
    model = _coder(docs, path)
    return append_steps(docs, [_encoding(model), _decoding(model), (lambda: _digesting(), DIGESTED)])
