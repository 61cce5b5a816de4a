"""Whitening against a dense eigensolver, and the solver's counts and intervals."""

from __future__ import annotations

import math

import numpy as np
import pytest

from clausemill.llm import whitening
from clausemill.llm.whitening import feast, inertia, intervals, top_components, tridiagonal, whiten

DDL = "vec_id long, embedding array<float>, n long, x string, component int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in vectors], DDL).repartition(3)


def check(spark, vectors, components=16):
    """The operator's rows against numpy on the same list."""
    good = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in good), key=lambda k: (sum(len(v) == k for _, v in good), k))
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in good if len(v) == d]
    fit = np.array(sorted({tuple(x) for _, x in good}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit * n - sums).astype(float) / n
    v = centred.T @ centred / n
    e, y = np.linalg.eigh(v)
    e, y = e[::-1], y[:, ::-1]
    rank = min(components, int((e > 1e-9 * e[0]).sum()))
    rows = whiten(frame(spark, vectors), components=components).collect()
    assert len(rows) == rank * len(good)
    got = {}
    for r in rows:
        assert r.n == n and r.identity_error < 1e-9
        assert math.isclose(r.explained, e[r.component - 1] / e.sum(), rel_tol=1e-9)
        got.setdefault((r.id, r.deviation), {}).setdefault(r.component, set()).add(r.whitened)
    sign = {}
    for i, x in good:
        far = np.array([n * c for c in x], dtype=object) - sums
        w = far.astype(float) / n @ y / np.sqrt(np.maximum(e, 1e-300))
        mine = got[i, int((far * far).sum())]
        assert sorted(mine) == list(range(1, rank + 1))
        for k in range(rank):
            # eigenvectors are sure only where eigenvalues differ
            if min([abs(e[k] - e[j]) for j in range(d) if j != k], default=1) > 1e-6 * e[0]:
                value, = mine[k + 1]
                sign.setdefault(k, 1 if abs(value - w[k]) < 1e-6 else -1)
                assert math.isclose(sign[k] * value, w[k], abs_tol=1e-6)
    return rows


def test_random_vectors_with_odd_rows(spark):
    r = np.random.default_rng(1)
    base = (r.standard_normal((300, 24)) * np.linspace(3, 0.2, 24)).astype(np.float32)
    vectors = [(int(i), x.tolist()) for i, x in enumerate(base)]
    vectors += [(7, vectors[3][1]), (7, vectors[3][1]), (None, vectors[5][1])] + [(900 + k, vectors[0][1]) for k in range(150)]
    vectors += [(1000, None), (1001, []), (1002, [None] * 24), (1003, [math.nan] * 24), (1004, [math.inf] + [0.0] * 23), (1005, [1.0] * 23), (1006, [0.0] * 23 + [-math.inf])]
    rows = check(spark, vectors)
    assert len({r.component for r in rows}) == 16
    assert sum(r.id is None for r in rows) == 16


@pytest.mark.parametrize("vectors", [
    [(1, [0.5, 1.0, 2.0]), (2, [1.5, 1.0, -2.0]), (3, [0.25, 1.0, 0.0])],
    [(i, [float(i)]) for i in range(9)],
    [(i, [float(i), float(i), float(2 * i)]) for i in range(5)],
    [(2 * i + s, [float(s) if j == i else 0.0 for j in range(20)]) for i in range(20) for s in (-1, 1)],
])
def test_low_rank_short_and_tied(spark, vectors):
    check(spark, vectors)


def test_nothing_to_whiten(spark):
    assert whiten(frame(spark, [])).collect() == []
    assert whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    assert whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []


def test_deviation_is_exact_beyond_small_numbers(spark):
    rows = whiten(frame(spark, [(1, [0.0, 3e5]), (2, [1e6, 0.0]), (3, [2.0, 1.0])]), components=1).collect()
    x = np.array([[0, 64 * 300_000], [64 * 1_000_000, 0], [128, 64]], dtype=object) + 1_000_000
    want = {i + 1: int(((3 * v - x.sum(axis=0)) ** 2).sum()) for i, v in enumerate(x)}
    assert {r.id: r.deviation for r in rows} == want


def matrices():
    r = np.random.default_rng(2)
    for d in (1, 2, 3, 10, 40):
        for e in (r.random(d), np.repeat(1.0, d), np.round(r.random(d) * 4), 10.0 ** -np.arange(d), np.append(np.zeros(d - 1), 1)):
            q, _ = np.linalg.qr(r.standard_normal((d, d)))
            v = q @ np.diag(e) @ q.T
            yield (v + v.T) / 2


def test_counts_intervals_and_pairs():
    for v in matrices():
        e = np.linalg.eigvalsh(v)
        diagonal, off = tridiagonal(v)
        for s in np.linspace(-0.13, 4.21, 41):
            if np.abs(e - s).min() > 1e-9:
                assert inertia(diagonal, off, s) == (e < s).sum()
        found = intervals(v, 16)
        assert sum(c for _, _, c in found) >= min(16, len(v))
        assert all(low == high for (low, _, _), (_, high, _) in zip(found, found[1:]))
        for low, high, count in found:
            values, vectors = feast(v, low, high, count)
            assert len(values) == count and np.allclose(v @ vectors, vectors * values, atol=1e-12)
        values, vectors = top_components(v, 16)
        assert np.allclose(values, e[::-1][: len(values)], atol=1e-13) and np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)


def test_a_missing_pair_is_noticed(monkeypatch):
    v = np.diag(np.arange(1.0, 9.0))
    with pytest.raises(ArithmeticError):
        feast(v, 5.5, 8.5, 4)
    monkeypatch.setattr(whitening, "_NODES", 2)
    values, _ = feast(v, 5.5, 8.5, 3)
    assert np.allclose(values, [6, 7, 8])
