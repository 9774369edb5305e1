"""Language ID (operator 1): multilingual mixture inference by expectation-maximisation.

Training counts letter n-grams (one to three, within words) per labelled language; every
task sends partial counts and Spark sums them.  A word has a likelihood under each language, the
product of its n-gram probabilities.  For a text, EM estimates the proportions of the languages
its words are mixed from.  The set of languages is chosen by penalised likelihood: the weakest
one is left out as long as that lowers  -2 log L + languages * log(words).  The prediction is the
language of the largest proportion; the score is that proportion.

Texts are read whole.  The model has at most languages x ``CELLS`` counts, whatever the data.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.batches import append_columns, held_out, map_rows

ORDERS = (1, 2, 3)
CELL_BITS = 13
CELLS = len(ORDERS) << CELL_BITS
EM_STEPS = 10
UNKNOWN = "und"
RESULT = "lang_pred string, score double, lang_shares map<string,double>"


@cache
def _letters() -> np.ndarray:
    """Per code point: the lower-case letter, or 0 for what is no letter."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] == "L":
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of the n-grams that end at each letter, one row for each order; where words begin; first word of each text.

    A mark stands before each word, so n-grams see its beginning; those that would reach over it are
    cut to the mark and count with the next lower order.
    """
    parts = [(t or "") + "\n" for t in texts]
    codes = _letters()[np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)]
    inside = codes > 0
    start = np.empty(len(codes), bool)
    start[0], start[1:] = inside[0], inside[1:] & ~inside[:-1]
    ends = np.cumsum([len(p) for p in parts])
    first = np.concatenate([[0], np.cumsum(start)[ends - 1]])
    place = np.flatnonzero(inside)
    begins = np.flatnonzero(start[place])
    one = codes[place].astype(np.uint64)
    fresh = start[place]
    cells = np.empty((len(ORDERS), len(one)), np.int32)
    with np.errstate(over="ignore"):
        gram = one
        for i, n in enumerate(ORDERS):
            if n > 1:
                longer = np.full(len(one), 7, np.uint64)
                longer[1:] = gram[:-1]
                longer[fresh] = 7
                gram = longer * np.uint64(0x9E3779B97F4A7C15) + one
            cells[i] = ((gram * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - CELL_BITS)).astype(np.int32) + i * (1 << CELL_BITS)
    return cells, begins, first


@dataclass
class Model:
    """Languages in order and the log probability of each n-gram cell."""

    languages: list[str]
    logs: np.ndarray  # cells x languages

    def words(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihood of each word under each language, and the first word of each text."""
        cells, begins, first = _grams(texts)
        if not len(begins):
            return np.zeros((0, len(self.languages)), np.float32), first
        total = self.logs[cells[0]]
        for cell in cells[1:]:
            total += self.logs[cell]
        return np.add.reduceat(total, begins, axis=0) / len(ORDERS), first

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, dict[str, float]]]:
        found = [(UNKNOWN, 0.0, {})] * len(texts)
        if not self.languages or not texts:
            return found
        logs, first = self.words(texts)
        count = np.diff(first)
        some = np.flatnonzero(count)
        if len(some):
            shares = mixtures(logs, count[some])
            for i, row in zip(some.tolist(), shares):
                best = int(row.argmax())
                found[i] = (
                    self.languages[best], float(min(1.0, row[best])),
                    {self.languages[k]: float(v) for k, v in enumerate(row) if v > 0},
                )
        return found


def _em(likely: np.ndarray, count: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of each text after ``EM_STEPS``, and the log likelihood up to a constant of the text."""
    begin = np.cumsum(count) - count
    for step in range(EM_STEPS + 1):
        joint = np.repeat(shares, count, axis=0)
        joint *= likely
        total = np.maximum(joint.sum(axis=1), 1e-30)
        if step == EM_STEPS:
            return shares, np.add.reduceat(np.log(total).astype(np.float64), begin)
        joint /= total[:, None]
        shares = (np.add.reduceat(joint, begin, axis=0) / count[:, None]).astype(np.float32)


def mixtures(logs: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Proportions of the languages for each text; ``logs``: words of all texts in a row, ``count`` of them each (over 0)."""
    logs = np.maximum(logs - logs.max(axis=1, keepdims=True), -30)
    likely = np.exp(logs)
    languages = likely.shape[1]
    begin = np.cumsum(count) - count
    shares, fit = _em(likely, count, np.full((len(count), languages), 1 / languages, np.float32))
    penalty = np.log(np.maximum(count, 2))
    # less than half a word: leaving it out costs less than the penalty saves
    active = shares * count[:, None] > 0.5
    active[np.arange(len(count)), shares.argmax(axis=1)] = True
    shares = np.where(active, shares, 0)
    shares /= shares.sum(axis=1, keepdims=True)
    going = np.arange(len(count))
    while len(going):
        going = going[active[going].sum(axis=1) > 1]
        if not len(going):
            break
        weakest = np.where(active[going], shares[going], np.inf).argmin(axis=1)
        trial = shares[going].copy()
        trial[np.arange(len(going)), weakest] = 0
        empty = trial.sum(axis=1) <= 0
        trial[empty] = active[going][empty]
        trial[np.arange(len(going)), weakest] = 0
        trial /= trial.sum(axis=1, keepdims=True)
        rows = np.concatenate([np.arange(begin[i], begin[i] + count[i]) for i in going])
        new, new_fit = _em(likely[rows], count[going], trial)
        better = 2 * (fit[going] - new_fit) < penalty[going]
        kept = going[better]
        shares[kept], fit[kept] = new[better], new_fit[better]
        active[kept, weakest[better]] = False
        going = kept
    return np.where(active, shares, 0)


def train(labelled: DataFrame) -> Model:
    """Model of all rows of ``labelled`` (``text``, ``lang``) whose language isn't null."""

    def make():
        counts: dict[str, np.ndarray] = {}

        def compute(piece):
            if piece is not None:
                langs = np.array(piece.column("lang").to_pylist(), object)
                texts = np.array(piece.column("text").to_pylist() + [None], object)[:-1]
                for lang in sorted(set(langs)):
                    own = counts.setdefault(lang, np.zeros(CELLS, np.int64))
                    own += np.bincount(_grams(list(texts[langs == lang]))[0].ravel(), minlength=CELLS)
                return
            for lang, own in counts.items():
                cell = np.flatnonzero(own)
                if len(cell):
                    yield {"lang": pa.array([lang] * len(cell)), "cell": pa.array(cell), "n": pa.array(own[cell])}

        return compute

    rows = labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    sums = map_rows(rows, make, "lang string, cell long, n long", finish=True).groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    table = sums.toArrow()
    languages = sorted(set(table.column("lang").to_pylist()))
    counts = np.zeros((len(languages), CELLS))
    index = {name: i for i, name in enumerate(languages)}
    counts[[index[x] for x in table.column("lang").to_pylist()], table.column("cell").to_numpy()] = table.column("n").to_numpy()
    by_order = counts.reshape(len(languages), len(ORDERS), 1 << CELL_BITS) + 0.5
    logs = np.log(by_order / by_order.sum(axis=2, keepdims=True)).reshape(len(languages), CELLS)
    return Model(languages, np.ascontiguousarray(logs.T, np.float32))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``lang_shares`` of its ``text``, replacing columns of these names.

    Null texts and texts without a letter are ``und`` with score 0 and no shares, and so is every
    text if nothing was learned.  Ties of proportions go to the language that sorts first.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def compute(piece):
            rows = held.value.predict(piece.column("text").to_pylist())
            return {
                "lang_pred": pa.array([r[0] for r in rows], pa.string()), "score": pa.array([r[1] for r in rows], pa.float64()),
                "lang_shares": pa.array([list(r[2].items()) for r in rows], pa.map_(pa.string(), pa.float64())),
            }

        return compute

    return append_columns(docs, make, RESULT)


def train_fold(docs: DataFrame) -> DataFrame:
    """Rows to learn from: all but the held-out fifth and rows without an id."""
    return docs.where(F.col("doc_id").isNotNull() & ~held_out())
