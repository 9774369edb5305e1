"""Quality classifier (operator 4): positive-unlabelled learning with the non-negative risk.

Trusted positives are the documents labelled 1; every other document of the training fold, labelled
or not, is unlabelled web text.  With class prior p, the risk  p R(P, +) + max(0, R(U, -) - p R(P, -))
is minimised: the second term estimates the risk on negatives, which can't be below 0.  The prior
is the share of positives among labelled rows if both values occur, else the Elkan-Noto estimate
from a first fit of positives against unlabelled.

The model is a small network on dense features of the whole text.  It is fitted on at most about
``LABEL_ROWS`` documents labelled 1, so on all of them while they are fewer, and about ``FIT_ROWS`` of
the whole fold as unlabelled text, both chosen by a hash of their id.  The prior is counted from all labels of
the fold.  Features are computed in tasks, and only they reach the driver.  Scoring reads every text whole and moves nothing.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.batches import append_columns, held_out

#: Bounds of the sample: of the whole fold, and of its documents labelled 1.
FIT_ROWS = 40_000
LABEL_ROWS = 40_000
THRESHOLD = 0.3
EPOCHS = 60
HIDDEN = 24
RESULT = "score double, predicted int"
_SHAPES = 7  # blank, line end, lower, upper, digit, mark, other mark
_WIDTH = 18 + _SHAPES * _SHAPES


def _shape_table() -> np.ndarray:
    table = np.full(0x3000, 2, np.uint8)
    for c in range(0x3000):
        s = chr(c)
        if s == "\n":
            table[c] = 1
        elif s.isspace():
            table[c] = 0
        elif s.isdigit():
            table[c] = 4
        elif s.isupper():
            table[c] = 3
        elif s in ".,;:'-":
            table[c] = 5
        elif not s.isalpha():
            table[c] = 6
    return table


_TABLE = _shape_table()


def features(text: str | None) -> np.ndarray:
    """Fixed-width description of a whole text; null counts as empty."""
    out = np.zeros(_WIDTH, np.float32)
    if not text:
        out[0] = 1
        return out
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    shape = np.where(codes < 0x3000, _TABLE[np.minimum(codes, 0x2FFF)], 2).astype(np.int64)
    n = len(shape)
    pairs = np.bincount(shape[:-1] * _SHAPES + shape[1:], minlength=_SHAPES**2).astype(np.float32)
    share = np.bincount(shape, minlength=_SHAPES) / n
    words, lines = text.split(), text.split("\n")
    w = max(len(words), 1)
    counts = Counter(words)
    line_counts = Counter(x.strip() for x in lines if x.strip())
    full = max(sum(line_counts.values()), 1)
    lengths = np.array([len(x) for x in words] or [0])
    same = sum(a == b for a, b in zip(words, words[1:]))
    letters = max(share[2] + share[3], 1e-6)
    out[1:18] = (
        np.log1p(n) / 10, np.log1p(w) / 10, *share[:2], share[3] / letters, share[4], share[5], share[6],
        lengths.mean() / 10, lengths.std() / 10, min(lengths.max(), 100) / 100, len(counts) / w, counts.most_common(1)[0][1] / w if counts else 0,
        same / w, 1 - len(line_counts) / full, w / full / 100, sum(x[-1] in ".!?" for x in words) / w,
    )
    out[18:] = np.sqrt(pairs / max(n - 1, 1))
    return out


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.center) / self.scale, -6, 6)
        a, b, c, d = self.weights
        return 1 / (1 + np.exp(-np.clip(np.tanh(x @ a + b) @ c + d, -30, 30)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7) -> Model:
    """Network that minimises the non-negative unbiased risk by Adam on mini-batches, with logistic loss."""
    rng = np.random.default_rng(seed)
    center, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    p, u = (np.clip((x - center) / scale, -6, 6) for x in (positive, unlabelled))
    weights = [rng.normal(0, 1 / np.sqrt(p.shape[1]), (p.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    batches = max(1, len(u) // 512)
    step = 0
    for epoch in range(EPOCHS):
        orders = np.array_split(rng.permutation(len(u)), batches)
        chosen = np.array_split(rng.permutation(np.resize(np.arange(len(p)), max(len(p), batches))), batches)
        for ui, pi in zip(orders, chosen):
            x = np.concatenate([p[pi], u[ui]])
            k = len(pi)
            h = np.tanh(x @ weights[0] + weights[1])
            z = h @ weights[2] + weights[3]
            s = _sigmoid(z)
            negative = np.logaddexp(0, z)  # loss of calling a row negative
            rest = negative[k:].mean() - prior * negative[:k].mean()
            grad = np.zeros(len(x))
            if rest >= 0:
                grad[:k] = prior * (s[:k] - 1) / k - prior * s[:k] / k
                grad[k:] = s[k:] / (len(x) - k)
            else:  # an impossible value: undo it
                grad[:k] = prior * s[:k] / k
                grad[k:] = -s[k:] / (len(x) - k)
            inner = (grad[:, None] * weights[2]) * (1 - h * h)
            grads = [x.T @ inner, inner.sum(axis=0), h.T @ grad, np.array([grad.sum()])]
            step += 1
            rate = 0.004 * (1 - 0.9 * epoch / EPOCHS)
            for i, g in enumerate(grads):
                g = g + 1e-4 * weights[i]
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                weights[i] = weights[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Model(center, scale, weights)


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Elkan-Noto: share of positives in ``unlabelled``, from a fit of positives against it."""
    model = fit(positive, unlabelled, len(positive) / (len(positive) + len(unlabelled)))
    top = np.quantile(model.scores(positive), 0.5)
    return float(np.clip(model.scores(unlabelled).mean() / max(top, 1e-6), 0.05, 0.95))


def _share(rows: int, of: int) -> Column:
    """Whether the hash of an id falls into a share of about ``rows`` of ``of``; all if they are fewer."""
    if of <= rows:
        return F.lit(True)
    return F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(rows / of * (1 << 40))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, label_rows: int = LABEL_ROWS) -> Model | None:
    """Model from the training fold of ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``quality``).

    A document with several labels is positive if all are 1; null labels don't count, nor labels without a
    document.  Without positives there is nothing to learn and the result is None.
    """
    fold = docs.where(F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "text")
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out()).groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    marked = fold.select("doc_id").join(marks.where("quality >= 0"), "doc_id")
    known = {r["quality"]: r["count"] for r in marked.groupBy("quality").count().collect()}
    if not known.get(1):
        return None

    def make():
        def compute(piece):
            rows = [features(t) for t in piece.column("text").to_pylist()]
            return {"features": pa.array([r.tobytes() for r in rows], pa.binary())}

        return compute

    trusted = marked.where((F.col("quality") == 1) & _share(label_rows, known[1])).select("doc_id", F.lit(True).alias("trusted")).distinct()
    chosen = fold.withColumn("drawn", _share(fit_rows, fold.count())).join(F.broadcast(trusted), "doc_id", "left")  # so texts stay in place
    chosen = chosen.withColumn("trusted", F.coalesce("trusted", F.lit(False))).where("drawn OR trusted")
    table = append_columns(chosen, make, "features binary").select("features", "drawn", "trusted").toArrow()
    x = np.frombuffer(b"".join(table.column("features").to_pylist()), np.float32).reshape(-1, _WIDTH).astype(np.float64)
    drawn, trusted = (np.array(table.column(c).to_pylist(), bool) for c in ("drawn", "trusted"))
    order = np.lexsort([*x.T[:8], drawn, trusted])  # so that the fit doesn't depend on the order of tasks
    x, drawn, trusted = x[order], drawn[order], trusted[order]
    positive, unlabelled = x[trusted], x[drawn]
    if not len(positive) or not len(unlabelled):
        return None
    prior = known[1] / sum(known.values()) if 0 in known else estimated_prior(positive, unlabelled)
    return fit(positive, unlabelled, prior)


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (that ``text`` is of label 1) and ``predicted``, replacing columns of these names.

    Null and empty texts are scored as empty; without a model every score is 0.5.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def compute(piece):
            texts = piece.column("text").to_pylist()
            if held.value is None:
                scores = np.full(len(texts), 0.5)
            else:
                scores = held.value.scores(np.stack([features(t) for t in texts]).astype(np.float64))
            return {"score": pa.array(scores, pa.float64()), "predicted": pa.array(scores >= threshold).cast(pa.int32())}

        return compute

    return append_columns(docs, make, RESULT)
