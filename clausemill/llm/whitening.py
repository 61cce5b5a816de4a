"""Embedding whitening: principal components of the covariance, found by contour integration, and projections on them.

Method: FEAST. The covariance V is a sum of centred products over blocks of vectors, made where the blocks are. Of its
spectrum only the wanted intervals are solved: for an interval (low, high) the projector on its eigenvectors is the
integral of (z - V)^-1 over a circle through both ends, here a Gauss-Legendre quadrature, so each step solves a few
complex shifted systems for a block of vectors. Rayleigh-Ritz in the space they span extracts the eigenpairs, which go
into the next step until residuals are at rounding level. How many eigenvalues an interval holds is known beforehand: by
Sylvester's law of inertia, the number of negative pivots of V - s counts the eigenvalues below s, taken from the
tridiagonal form of V, where the count is stable. Intervals are cut by these counts, and an interval is done only when
it has given as many eigenpairs as the counts say.

The driver holds n, the sums and V, whose size depends on the vectors' length alone, at most MAX_DIMENSIONS.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, materialize

MAX_DIMENSIONS = 4096
#: Vectors are whole numbers of 1/SCALE, moved by OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Eigenvalues of an interval at most, unless more cannot be told apart.
PER_INTERVAL = 6
_NODES = 8
_EPS = np.finfo(float).eps


# ---------------------------------------------------------------- eigenpairs of a symmetric matrix


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of the tridiagonal form of a symmetric matrix, by Householder reflections."""
    a = v.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(x)
        if size == 0:
            continue
        x /= size
        rest = a[k + 1 :, k + 1 :]
        p = rest @ x
        w = 2 * (p - (x @ p) * x)
        rest -= np.outer(x, w) + np.outer(w, x)
        a[k + 1 :, k] -= 2 * x * (x @ a[k + 1 :, k])
    return np.diag(a).copy(), np.diag(a, -1).copy()


def inertia(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """The number of eigenvalues below ``shift``: negative pivots of the shifted tridiagonal matrix."""
    least = _EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    below, pivot = 0, 1.0
    for k, d in enumerate(diagonal):
        pivot = d - shift - (off[k - 1] ** 2 / pivot if k else 0.0)
        if abs(pivot) < least:
            pivot = -least
        below += pivot < 0
    return below


def intervals(v: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) of intervals, from the top, that hold the ``wanted`` largest eigenvalues or more
    where the last ones cannot be told apart. Ends are moved into gaps by bisection on the counts."""
    diagonal, off = tridiagonal(v)
    n = len(diagonal)
    reach = np.abs(np.append(off, 0)) + np.abs(np.insert(off, 0, 0))
    least, most = float((diagonal - reach).min()), float((diagonal + reach).max())
    margin = max(abs(least), abs(most), np.finfo(float).tiny)
    least, most = least - 1e-3 * margin, most + 1e-3 * margin
    above = lambda s: n - inertia(diagonal, off, s)

    def gap(k: int) -> tuple[float, float] | None:
        """A stretch between the k-th and the next smaller eigenvalue, or None if they cannot be told apart."""
        low, high = least, most  # above(low) > k, above(high) <= k
        while above(mid := (low + high) / 2) != k:
            low, high = (low, mid) if above(mid) < k else (mid, high)
            if high - low <= 64 * _EPS * margin:
                return None
        # Widen to both eigenvalues, so that the end lies well between them.
        ends = []
        for inner, outer in ((mid, high), (mid, low)):
            for _ in range(12):
                m = (inner + outer) / 2
                inner, outer = (m, outer) if above(m) == k else (inner, m)
            ends.append(inner)
        return ends[1], ends[0]

    def cut(first: int, last: int) -> float | None:
        """The middle of the widest gap after an eigenvalue numbered from ``first`` to ``last``."""
        found = [g for g in map(gap, range(first, last + 1)) if g]
        return max((b - a, (a + b) / 2) for a, b in found)[1] if found else None

    out, high, taken = [], most, 0
    while taken < min(wanted, n):
        size = PER_INTERVAL
        low = None
        while low is None:
            if taken + size >= n:
                low = least
            elif taken + size >= wanted:
                low = cut(wanted, min(n - 1, max(wanted + 2, taken + size)))
            else:
                low = cut(taken + max(1, size // 2), taken + size)
            size *= 2
        count = above(low) - taken
        out.append((low, high, count))
        high, taken = low, taken + count
    return out


def _subspace(v: np.ndarray, low: float, high: float, y: np.ndarray) -> np.ndarray:
    """The quadrature of the projector on (low, high), applied to ``y``. The lower half circle is the conjugate."""
    x, weight = np.polynomial.legendre.leggauss(_NODES)
    middle, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(y)
    eye = np.eye(len(v))
    for angle, w in zip(np.pi * (x + 1) / 2, weight):
        turn = np.exp(1j * angle)
        out += (w / 2 * radius * turn * np.linalg.solve((middle + radius * turn) * eye - v, y.astype(complex))).real
    return out


def feast(v: np.ndarray, low: float, high: float, count: int, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of ``v`` in (low, high). The block starts a half wider than the count and doubles while
    pairs are missing."""
    n = len(v)
    size = min(n, count + count // 2 + 4)
    scale = max(abs(low), abs(high), float(np.abs(v).max()))
    while True:
        y = np.random.default_rng(1).standard_normal((n, size))
        last = np.inf
        for _ in range(steps):
            q, _ = np.linalg.qr(_subspace(v, low, high, y) if size < n else np.eye(n))
            e, s = np.linalg.eigh(q.T @ v @ q)
            y = q @ s
            inside = np.flatnonzero((e > low) & (e < high))
            if len(inside) == count:
                worst = float(np.linalg.norm(v @ y[:, inside] - y[:, inside] * e[inside], axis=0).max())
                if worst <= 4 * n * _EPS * scale and worst >= last / 2:
                    return e[inside], y[:, inside]
                last = worst
        if size == n:
            raise ArithmeticError(f"{count} eigenvalues expected in ({low}, {high})")
        size = min(n, 2 * size)


def top_components(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.
    Eigenvalues not above rounding errors of the matrix are left out. The block of all intervals is made orthogonal by one
    last Rayleigh-Ritz step, and the number of pairs is that of the inertia counts."""
    largest = float(np.abs(v).max(initial=0.0))
    if not len(v) or largest == 0:
        return np.zeros(0), np.zeros((len(v), 0))
    pairs = [feast(v, *where) for where in intervals(v, wanted)]
    q, _ = np.linalg.qr(np.concatenate([y for _, y in pairs], axis=1))
    e, s = np.linalg.eigh(q.T @ v @ q)
    order = np.argsort(-e)[:wanted]
    order = order[e[order] > 8 * len(v) * _EPS * largest * len(v) ** 0.5]
    return e[order], (q @ s)[:, order]


# ---------------------------------------------------------------- tables


def _whole(vector: str) -> Column:
    """The entries as whole numbers, x."""
    return F.transform(vector, lambda c: (F.floor(c.cast("double") * SCALE) + OFFSET).cast("long"))


def usable(rows: DataFrame, vector: str, id_column: str) -> DataFrame:
    """(id, x): the rows whose vector has entries, all of them finite numbers, as whole numbers. Of vectors of different
    lengths those of the commonest length stay, the longer one on a tie."""
    c = F.col(f"`{vector}`")
    fine = F.coalesce((F.size(c) > 0) & F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))), F.lit(False))
    out = rows.where(fine).select(F.col(f"`{id_column}`").alias("id"), _whole(f"`{vector}`").alias("x"))
    # A row for each length that occurs.
    lengths = Counter({r[0]: r[1] for r in out.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()})
    if len(lengths) > 1:
        out = out.where(F.size("x") == max(lengths, key=lambda d: (lengths[d], d)))
    return out


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sums(fit: DataFrame, d: int, of, width: int) -> np.ndarray:
    """The sum over the fit list of ``of(block)``, a square matrix of ``width`` for each block of x vectors. Each task sends
    its own sum, a row for each row of the matrix; Spark adds them by row and column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                total += of(_matrix(b.column(0)[at : at + 4096], d))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["at", "v"])

    cells = fit.select("x").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v"))
    out = np.zeros(width * width)
    for at, v in cells.collect():  # a number for each cell of the matrix
        out[at] = v
    return out.reshape(width, width)


_OUT = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, vector: str = "embedding", id_column: str = "vec_id", components: int = 16) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), ``components`` rows for each usable row.

    A row is left out if its vector is null or empty or holds a null or an entry that is not finite, and so are vectors of
    another length than most; rows with a null or a repeated id stay. Entries become whole numbers
    floor(64 * c) + 1000000, which must fit into 64 bits. The fit list holds each different vector once: n of them with
    sums S. deviation is the sum of (n * x - S)^2 over the dimensions, exact, and an error if it passes 64 bits. whitened
    is x - S / n projected on a component, over the root of its eigenvalue; explained is the eigenvalue's share of the
    trace; identity_error is the largest entry of the whitened fit list's covariance less the identity. Components fall by
    eigenvalue, have either sign, and are fewer where the vectors are shorter or their covariance has a lower rank: a table
    whose vectors are all alike gives no rows, and so does an empty one. Other columns are ignored.
    """
    spark = rows.sparkSession
    ready = usable(rows, vector, id_column)
    fit = materialize(ready.select("x").distinct())
    head = fit.select(F.size("x")).first()
    empty = spark.createDataFrame([], _OUT)
    if head is None:
        forget(fit)
        return empty
    d = head[0]
    if d > MAX_DIMENSIONS:
        raise ValueError(f"vectors have {d} entries, more than {MAX_DIMENSIONS}")
    # Sums fit decimals at any size; a row for each dimension.
    cells = fit.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).collect()
    n = int(cells[0]["n"])
    sums = [0] * d
    for r in cells:
        sums[r["at"]] = int(r["s"])
    # x - S / n without loss: whole numbers near the mean go first, what is left of it is below one.
    near = np.array([s // n for s in sums], dtype=np.int64)
    left = np.array([(s % n) / n for s in sums])
    centred = lambda x: (x - near).astype(np.float64) - left

    def products(x: np.ndarray) -> np.ndarray:
        c = centred(x)
        return c.T @ c

    v = _sums(fit, d, products, d) / n
    e, vectors = top_components((v + v.T) / 2, components)
    k = len(e)
    if not k:
        forget(fit)
        return empty
    base = vectors / np.sqrt(e)
    explained = (e / np.trace(v)).tolist()

    def whitened_sums(x: np.ndarray) -> np.ndarray:
        w = np.concatenate([centred(x) @ base, np.ones((len(x), 1))], axis=1)
        return w.T @ w

    both = _sums(fit, d, whitened_sums, k + 1) / n
    mean = both[k, :k]

    def rest(x: np.ndarray) -> np.ndarray:
        c = centred(x) @ base - mean
        return c.T @ c

    error = float(np.abs(_sums(fit, d, rest, k) / n - np.eye(k)).max())
    forget(fit)
    remainder = np.array([s % n for s in sums], dtype=object)

    def deviations(x: np.ndarray) -> np.ndarray:
        """Exact: in 64 bits where all products surely fit, else in whole numbers of any length."""
        far = x - near
        most = int(np.abs(far).max(initial=0)) + 1
        if n * most < 2**62 and d * (n * most) ** 2 < 2**62:
            step = far * n - remainder.astype(np.int64)
            return (step * step).sum(axis=1)
        step = far.astype(object) * n - remainder
        return np.array((step * step).sum(axis=1).tolist(), dtype=np.int64)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                x = _matrix(part.column(1), d)
                m = len(x)
                w = centred(x) @ base
                own = pa.array(np.repeat(np.arange(m), k))
                cols = [part.column(0).take(own), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), pa.array(np.repeat(deviations(x), k)), pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))]
                yield pa.RecordBatch.from_arrays(cols, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return ready.select(F.col("id").cast("long").alias("id"), "x").mapInArrow(project, _OUT)
