"""Embedding whitening (operator 13): principal components by FEAST contour integration.

Each component c of a vector becomes the long x = floor(64 c) + 1000000.  The fit list holds each distinct x
vector once, written as a table.  Over it Spark sums, in exact integers, n and S and then the products of
entries centred at floor(S / n); the remaining offset, below 1 in each dimension, is taken off in exact
rationals, so the covariance is right to its last rounding and does not depend on how rows are dealt.

What is left for the driver has the size of the covariance, never that of the rows (``MAX_DIM`` bounds it):

* *inertia*: the signs of the pivots of V - s I, after one reduction to tridiagonal form, count the
  eigenvalues below any s.  Bisection on these counts finds gaps that cut the wanted part of the
  spectrum into slices of about ``SLICE`` eigenvalues;
* *contour*: on a circle around each slice, (z I - V) X = Y is solved at Gauss-Legendre nodes z and the solutions
  are summed, which leaves of Y only what belongs to eigenvalues inside;
* *Rayleigh-Ritz* on that subspace gives the slice's pairs; both steps repeat until the residual is at rounding level;
* the number of pairs found inside must equal the inertia count of the slice, or the subspace grows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.batches import Scratch, importable

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
MAX_DIM = 8192  # the covariance is held on the driver: 512 MB at this length
SLICE = 8
NODES = 12
ROUNDS = 40
_CELLS = 1 << 20  # entries handled at once in a task


# ---------------------------------------------------------------- eigenvalues by inertia, eigenvectors by contour


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues of the symmetric ``matrix`` (Householder)."""
    a = matrix.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0 or not np.any(x[1:]):
            continue
        x[0] += norm if x[0] >= 0 else -norm
        x /= np.linalg.norm(x)
        part = a[k + 1 :, k:]
        part -= 2.0 * np.outer(x, x @ part)
        part = a[k:, k + 1 :]
        part -= 2.0 * np.outer(part @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """Number of eigenvalues above ``shift``: positive pivots of T - shift I (Sylvester's law of inertia)."""
    least = np.finfo(float).eps * (float(np.abs(diagonal).max(initial=0)) + float(np.abs(off).max(initial=0)) + abs(shift)) or 1e-300
    squares = off * off
    above, pivot = 0, 1.0
    for i, d in enumerate(diagonal):
        pivot = d - shift - (squares[i - 1] / pivot if i else 0.0)
        if abs(pivot) < least:
            pivot = -least
        above += pivot > 0
    return above


def _located(diagonal, off, wanted: int, bound: float) -> list[float]:
    """Eigenvalues 1 to ``wanted`` from the largest, each within bound / 2^22, by bisection on inertia counts."""
    found = []
    for i in range(1, wanted + 1):
        low, high = -bound, (found[-1] + bound / 2**21 if found else bound)
        for _ in range(24):
            middle = (low + high) / 2
            low, high = (middle, high) if count_above(diagonal, off, middle) >= i else (low, middle)
        found.append((low + high) / 2)
    return found


def contour_pairs(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between ``low`` and ``high`` and their unit vectors (columns), by FEAST."""
    d = len(matrix)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(-0.5j * np.pi * (nodes - 1))
    centre, radius = (low + high) / 2, (high - low) / 2
    scale = np.abs(matrix).sum(axis=1).max() or 1.0
    enough = 4 * np.finfo(float).eps * scale
    size = min(d, count + max(4, count // 2))
    while True:
        subspace = np.random.Generator(np.random.PCG64(13)).standard_normal((d, size))
        best, kept = np.inf, None
        for _ in range(ROUNDS):
            filtered = np.zeros((d, size))
            for turn, weight in zip(turns, weights):
                solved = np.linalg.solve((centre + radius * turn) * np.eye(d) - matrix, subspace.astype(complex))
                filtered += 0.5 * weight * (radius * turn * solved).real
            basis, _ = np.linalg.qr(filtered)
            ritz, mixed = np.linalg.eigh(basis.T @ matrix @ basis)
            subspace = basis @ mixed
            inside = (ritz > low) & (ritz < high)
            if inside.sum() != count:
                continue
            vectors = subspace[:, inside]
            residual = np.linalg.norm(matrix @ vectors - vectors * ritz[inside], axis=0).max()
            if residual < best:
                better, best, kept = residual < best / 2, residual, (ritz[inside], vectors)
            else:
                better = False
            if best <= enough or (not better and best <= 1e3 * enough):
                return kept
        if size == d:
            raise ArithmeticError(f"inertia counts {count} eigenvalues between {low} and {high}, the contour did not settle on them")
        size = min(d, 2 * size)


def largest_pairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit vectors as columns, the entry of largest size positive.

    Eigenvalues not above rounding level (d * eps of the largest) are left out: their direction is not defined.
    """
    d = len(matrix)
    bound = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if d == 0 or bound == 0.0:
        return np.zeros(0), np.zeros((d, 0))
    bound *= 1.001
    diagonal, off = tridiagonal(matrix)
    near = bound / 2**19  # closer ones are not cut apart
    top = _located(diagonal, off, 1, bound)[0]
    wanted = min(wanted, count_above(diagonal, off, d * np.finfo(float).eps * top))
    vectors = []
    places = _located(diagonal, off, min(d, wanted + SLICE), bound)
    while len(places) < d and places[wanted - 1] - places[-1] <= near:  # a cluster reaches over the end
        places = _located(diagonal, off, min(d, 2 * len(places)), bound)
    gaps = [i for i in range(1, len(places)) if places[i - 1] - places[i] > near]
    if len(places) == d:
        gaps.append(d)
    begin, high = 0, bound
    while begin < wanted:
        fitting = [g for g in gaps if begin < g <= begin + SLICE] or [next(g for g in gaps if g > begin)]
        width = {g: places[g - 1] - (places[g] if g < d else -bound) for g in fitting}
        end = max(fitting[len(fitting) // 2 :], key=width.get) if any(g < wanted for g in fitting) else next(g for g in fitting if g >= wanted)
        low = (places[end - 1] + places[end]) / 2 if end < d else places[-1] - bound / 2**10
        count = count_above(diagonal, off, low) - count_above(diagonal, off, high)
        vectors.append(contour_pairs(matrix, low, high, count)[1])
        begin, high = end, low
    # Rayleigh-Ritz once more on all slices: neighbours in different slices become orthogonal to rounding
    basis, _ = np.linalg.qr(np.concatenate(vectors, axis=1))
    ritz, mixed = np.linalg.eigh(basis.T @ matrix @ basis)
    values, vectors = ritz[::-1][:wanted], (basis @ mixed)[:, ::-1][:, :wanted]
    strongest = vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)]
    return values, vectors * np.where(strongest < 0, -1.0, 1.0)


# ---------------------------------------------------------------- Spark passes


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(vec_id, x array<long>) of ``vectors`` (``vec_id``, ``embedding``) whose vector has only finite components."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))

    def whole(c):
        scaled = F.floor(c.cast("double") * SCALE)
        return F.when(F.abs(c.cast("double")) < 2.0**52, scaled + F.lit(SHIFT)).otherwise(
            F.raise_error(F.lit("a component is too large for whole numbers that a double holds exactly")).cast("long")
        )

    kept = vectors.select("vec_id", "embedding").where(F.coalesce(finite, F.lit(False)))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("x"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Row ranges of batches with their x as a matrix of at most about ``_CELLS`` entries."""
    for batch in batches:
        if not batch.num_rows:
            continue
        dim = len(batch.column("x")[0])
        step = max(1, _CELLS // max(1, dim))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dim)


def _summed(rows: DataFrame, partial, kind: str) -> dict[tuple[int, int], object]:
    """Sums over all tasks of what ``partial`` yields: {(i, j): v}; as many entries as the answer has, at any number of rows."""
    table = rows.mapInArrow(partial, f"i int, j int, v {kind}").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    return {(i, j): v for i, j, v in zip(*(table.column(c).to_pylist() for c in ("i", "j", "v")))}


def _entries(values, kind: pa.DataType) -> pa.RecordBatch:
    i, j, v = zip(*values) if values else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(v, kind)], names=["i", "j", "v"])


_EXACT = pa.decimal128(38, 0)


def _totals(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """n and S, exact."""

    def partial(batches):
        n, sums = 0, [0] * dim
        for _, x in _slices(batches):
            n += len(x)
            sums = [a + int(b) for a, b in zip(sums, x.sum(axis=0, dtype=object if np.abs(x).max() > 2**40 else np.int64))]
        yield _entries([(-1, -1, Decimal(n))] + [(i, -1, Decimal(s)) for i, s in enumerate(sums)], _EXACT)

    found = _summed(fit, partial, "decimal(38,0)")
    return int(found[-1, -1]), [int(found[i, -1]) for i in range(dim)]


def _products(fit: DataFrame, dim: int, centre: list[int]) -> dict[tuple[int, int], int]:
    """Sums of (x_i - centre_i) (x_j - centre_j) for i <= j, exact: doubles hold each slice's sums, whole numbers the rest."""
    middle = np.array(centre, np.int64)

    def partial(batches):
        total = np.zeros((dim, dim), object)
        for _, x in _slices(batches):
            z = x - middle
            most = int(np.abs(z).max(initial=0)) ** 2
            step = 2**53 // max(1, most)
            if step == 0:
                z = z.astype(object)
                total += z.T @ z
                continue
            z = z.astype(float)
            for at in range(0, len(z), step):
                part = z[at : at + step]
                total += (part.T @ part).astype(np.int64).astype(object)
        yield _entries([(i, j, Decimal(total[i, j])) for i in range(dim) for j in range(i, dim)], _EXACT)

    return {k: int(v) for k, v in _summed(fit, partial, "decimal(38,0)").items()}


@dataclass
class Whitening:
    """What was learned from the fit list; ``sums`` and ``n`` are exact, ``vectors`` has one column for each component."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float = 0.0

    def explained(self) -> np.ndarray:
        return self.values / np.trace(self.covariance) if len(self.values) else self.values

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n x - S, exact, and the whitened values of rows of x."""
        if float(np.abs(x).max(initial=0)) * self.n >= 2.0**62:
            raise OverflowError("n times a component doesn't fit in a long")
        far = x * np.int64(self.n) - np.array(self.sums, np.int64)
        return far, ((far / self.n) @ self.vectors) / np.sqrt(self.values)


def fit_whitening(fit: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """Whitening of the rows of ``fit`` (``x``, arrays of ``dim`` longs, at least one row), each counted once.

    A covariance of several millions of entries and more would not fit the driver: ``dim`` above ``MAX_DIM`` is refused.
    """
    if dim > MAX_DIM:
        raise ValueError(f"vectors of {dim} components: the covariance of more than {MAX_DIM} is not held on the driver")
    n, sums = _totals(fit, dim)
    if max((abs(s) for s in sums), default=0) >= 2**62:
        raise ValueError("sums of these vectors don't fit in a long")
    centre = [s // n for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]
    products = _products(fit, dim, centre)
    covariance = np.zeros((dim, dim))
    for (i, j), v in products.items():
        covariance[i, j] = covariance[j, i] = float(Fraction(n * v - rest[i] * rest[j], n * n))
    values, vectors = largest_pairs(covariance, components)
    model = Whitening(n, sums, covariance, values, vectors)
    k = len(values)

    def partial(batches):
        mean, square = np.zeros(k), np.zeros((k, k))
        for _, x in _slices(batches):
            _, white = model.project(x)
            mean += white.sum(axis=0)
            square += white.T @ white
        yield _entries(
            [(i, -1, mean[i]) for i in range(k)] + [(i, j, square[i, j]) for i in range(k) for j in range(k)], pa.float64()
        )

    if k:
        found = _summed(fit, partial, "double")
        mean = np.array([found[i, -1] for i in range(k)]) / n
        square = np.array([[found[i, j] for j in range(k)] for i in range(k)]) / n
        model.identity_error = float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())
    return model


COLUMNS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """One row for each row of ``rows`` (``vec_id``, ``x``) and component, numbered from 1 by falling eigenvalue."""
    importable(rows.sparkSession)
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        explained = model.explained()
        for part, x in _slices(batches):
            if not k:
                continue
            far, white = model.project(x)
            if float(np.abs(far).max()) ** 2 * far.shape[1] >= 2.0**63:
                raise OverflowError("a deviation doesn't fit in a long")
            rows = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n, np.int64)),
                    pa.array(np.repeat((far * far).sum(axis=1), k)),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, model.identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, COLUMNS)


def whiten(vectors: DataFrame, scratch: Scratch, components: int = COMPONENTS) -> DataFrame:
    """Whitened components of every row of ``vectors`` (``vec_id``, ``embedding``; further columns are ignored).

    Rows whose vector is null or holds null or non-finite components are dropped.  Equal vectors count once in the
    fit and each gets its rows; a null id stays null.  Vectors of different lengths are fitted apart.  Components
    without variance are left out, so equal vectors only, a single row, empty vectors and no rows give no rows.
    Components beyond 2^52 and deviations that a long can't hold raise an error.
    """
    rows = scratch.keep(whole_numbers(vectors))
    fit = scratch.keep(rows.select("x").distinct())  # equal vectors meet after a partial distinct in each task
    lengths = sorted(r[0] for r in fit.select(F.size("x").alias("dim")).distinct().collect())
    out = rows.sparkSession.createDataFrame([], COLUMNS)
    for dim in lengths:
        if dim == 0:
            continue
        own = (F.size("x") == dim) if len(lengths) > 1 else F.lit(True)
        out = out.unionByName(whitened(rows.where(own), fit_whitening(fit.where(own), dim, components)))
    return out
