"""Mixing by the cube method and whitening by contour integration against plain arithmetic."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from starloom.llm import mixing, whiten
from starloom.llm.batches import Scratch

SCHEMA = "doc_id long, text string, source string, size string, KEY int, shard map<string,int>"


def shares(sizes):
    """Targets by literal resharing, source by source."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: [3, 1, 2][i % 3] for i, s in enumerate(order)}
    target, goal = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in target]
        left = goal - sum(target.values())
        level = left / sum(weight[s] for s in free) if free else 0
        above = [s for s in free if weight[s] * level > 2 * sizes[s]]
        if not above:
            return {**target, **{s: weight[s] * level for s in free}}
        target |= {s: 2.0 * sizes[s] for s in above}


def documents(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(900):
        source = [None, "", "b", "é", "a", "hot", "hot", "hot", "z"][rng.integers(9)]
        n = int(rng.choice([0, 1, 5, 30, 300]))
        rows.append((i if i % 50 else None, [" \t" + "w\x0b" * n, "x y " * n, None][rng.choice(3, p=[0.6, 0.3, 0.1])], source, "s", i, {"a": 1}))
    rows += rows[:5] + [(9999, "long " * 200_000, "hot", "s", 1, None), (9998, "one", "small", "s", 1, None)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("shard_rows", [1 << 17, 40])
def test_mix(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(mixing, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(mixing, "FAN", 3)
    rows, frame = documents(spark)
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    sizes = defaultdict(int)
    for r, n in zip(rows, size):
        sizes[r[2]] += n
    wanted = shares(sizes)
    mixed = mixing.mix(frame, Scratch(spark))
    out = mixed.collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in out) == Counter((r[0], r[2], n) for r, n in zip(rows, size))
    taken = defaultdict(int)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(wanted[r["source"]], rel=1e-12)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2 and (r["size"] or not r["copies"])
        taken[r["source"]] += r["taken"]
    for s, n in taken.items():
        assert abs(n - wanted[s]) <= max(3, 0.01 * wanted[s]) or s == "hot" and abs(n - wanted[s]) <= 200_000
    again = mixing.mix(frame.repartition(7), Scratch(spark)).collect()
    assert sorted(map(repr, (r.asDict().items() for r in again))) == sorted(map(repr, (r.asDict().items() for r in out)))
    whole = Counter((r["doc_id"], r["source"], r["text"]) for r in mixing.mixture(frame, mixed).collect())
    assert sum(whole.values()) == sum(r["copies"] for r in out)


def test_flight_keeps_totals_and_expectations():
    import random

    chance, hits = random.Random(1), np.zeros(3)
    for _ in range(4000):
        units = [[0.3, 5], [0.5, 9], [0.8, 20]]
        mixing._step(units, chance)
        p = np.array([u[0] for u in units])
        assert p.sum() == pytest.approx(1.6) and p @ [5, 9, 20] == pytest.approx(22.0)
        assert p.min() < 1e-9 or p.max() > 1 - 1e-9
        hits += p
    assert hits / 4000 == pytest.approx([0.3, 0.5, 0.8], abs=0.02)
    assert mixing._landed([[0.5, 4], [0.5, 3], [0.5, 7]]) in ([0, 0, 1], [1, 1, 0])
    assert mixing._landed([]) == []


def test_mix_of_nothing(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(frame, Scratch(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a", None, None, None), (2, " ", None, None, None, None)], SCHEMA)
    assert {(r["taken"], r["target"], r["source_size"]) for r in mixing.mix(blank, Scratch(spark)).collect()} == {(0, 0.0, 0)}


def spectra():
    rng = np.random.default_rng(2)
    for d in (1, 2, 7, 40):
        a = rng.normal(size=(d + 9, d)) * rng.uniform(0.1, 9, d)
        yield a.T @ a / len(a), min(d, 16)
    yield np.eye(20) * 3, 16
    yield np.diag([5.0] * 30 + [1.0] * 9), 16
    yield np.diag([5.0] * 15 + [5 - 1e-5] * 4 + [1.0] * 20), 16
    yield np.zeros((4, 4)), 0
    a = rng.normal(size=(6, 30))
    yield a.T @ a, 6


@pytest.mark.parametrize("case", range(9))
def test_contour_finds_all_pairs(case):
    matrix, count = list(spectra())[case]
    values, vectors = whiten.largest_pairs(matrix, 16)
    wanted = np.linalg.eigvalsh(matrix)[::-1]
    scale = max(wanted[0], 1e-300)
    assert len(values) == count and np.allclose(values, wanted[:count], rtol=0, atol=1e-13 * scale)
    assert np.abs(matrix @ vectors - vectors * values).max(initial=0) <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(count)).max(initial=0) <= 1e-12
    diagonal, off = whiten.tridiagonal(matrix)
    for at in (-1.0, 0.5 * scale, 0.9 * scale, 2 * scale):
        assert whiten.count_above(diagonal, off, at) == (wanted > at).sum()


def test_whitening(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=5) @ rng.normal(size=(5, 5))).tolist(), i) for i in range(200)]
    rows += [(300, rows[0][1], 1), (301, rows[0][1], 1), (None, rows[1][1], 1), (7, rows[2][1], 0)]
    rows += [(400, None, 1), (401, [], 1), (402, [1.0, None, 0.0, 0.0, 0.0], 1), (403, [float("nan")] * 5, 1), (404, [float("-inf")] * 5, 1)]
    rows += [(500, [1.0, 2.0], 1), (501, [2.0, 2.5], 1), (502, [2.0, 1.0], 1), (600, [4.0], 1)]
    out = whiten.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int"), Scratch(spark)).toPandas()
    kept = [(i, v) for i, v, _ in rows if v and None not in v and len(v) == 5 and np.isfinite(v).all()]
    x = np.floor(64 * np.array([v for _, v in kept])).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    e, u = np.linalg.eigh(np.cov(fit.T, bias=True))
    five = out[~out.vec_id.isin([500, 501, 502])]
    assert len(five) == 5 * len(kept) and set(five.n) == {n} and five.identity_error.max() <= 1e-10
    assert sorted(five[five.component == 2].deviation) == sorted(((n * x - s) ** 2).sum(axis=1))
    for c in range(1, 6):
        one = five[five.component == c]
        assert one.explained.iloc[0] == pytest.approx(e[5 - c] / e.sum(), rel=1e-9)
        want = ((x - s / n) @ u[:, 5 - c]) / np.sqrt(e[5 - c])
        got = {tuple(sorted(np.round(sign * one.whitened, 7))) for sign in (1, -1)}
        assert tuple(sorted(np.round(want, 7))) in got
    assert out.vec_id.isna().sum() == 5 and (out.vec_id == 300).sum() == 5
    two = out[out.vec_id.isin([500, 501, 502])]
    assert len(two) == 6 and set(two.n) == {3} and 600 not in set(out.vec_id)


def test_whitening_without_variance(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whiten.whiten(frame, Scratch(spark)).count() == 0
    assert whiten.whiten(frame.where("false"), Scratch(spark)).count() == 0
    far = spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        whiten.whiten(far, Scratch(spark)).collect()
