"""Whitening of embeddings: principal directions by pivoted Cholesky and one-sided Jacobi.

Vectors are put on an integer grid first, x = floor(step * c) + offset, so that sums are
exact in whatever order tasks send them. One scan sums the grid points, a second one adds up
the scatter of what is left after the mean is taken off (centred before multiplying, so a
large offset costs no digits). A task sends one row for each row of the scatter matrix; what
meets is added up as it streams in, never gathered. The driver holds matrices of dimension by
dimension and nothing that grows with the rows: the scatter is factored as P'VP = LL' by
Cholesky with complete pivoting, then the columns of L are rotated pairwise until they are
orthogonal (one-sided Jacobi, on the triangular factor itself, no product is formed again).
Squared column norms are the eigenvalues of V, the normalised columns its eigenvectors.
A third scan projects every vector.

Rows with a null vector, or with null or non-finite entries, are dropped. So are vectors
whose length is not the most common one (ties: the longer), and empty ones. Entries beyond
2^53 / step count as that bound. Directions without variance (an eigenvalue under `d` rounding
errors of the largest) can't be whitened and are left out; a table of equal vectors, of one
vector or of none gives no rows. Rows of equal ids, or of null ids, each count and come back.
A deviation beyond a long is null. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tertulia.sources.shared import written

STEP = 1024
OFFSET = 100_000
TOP = 8

#: Entries of a matrix that a task works on at once.
ENTRIES = 1 << 18
_BOUND = float(1 << 53)
_LOW = 26
_SWEEPS = 60


@dataclass(frozen=True)
class Fit:
    """n vectors of d entries with exact sums per dimension; components are columns of unit
    length, their eigenvalues fall, trace is that of the covariance."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float


def _grids(batch: pa.RecordBatch, step: float, offset: int, dim: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Dimension, row numbers and grid points of the usable vectors of a batch, some rows at a time."""
    lists = batch.column("vector")
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    for d in [dim] if dim else np.unique(lengths[lengths > 0]).tolist():
        at, rows = np.flatnonzero(lengths == d), max(1, ENTRIES // d)
        for first in range(0, len(at), rows):
            part = at[first: first + rows]
            entries = lists.take(pa.array(part)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, d)
            good = np.isfinite(entries).all(axis=1)
            with np.errstate(over="ignore"):
                points = np.floor(np.clip(entries[good] * step, -_BOUND, _BOUND)).astype(np.int64) + offset
            yield d, part[good], points


def _vectors(rows: DataFrame, key: str, column: str) -> DataFrame:
    return rows.select(F.col(key).cast("long").alias("key"), F.col(column).alias("vector"))


def _sums(vectors: DataFrame, step: float, offset: int) -> tuple[int, list[int]]:
    """Number and sums per dimension of the vectors of the most common length."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for d, rows, points in _grids(batch, step, offset):
                own = totals.setdefault(d, [0, np.zeros(d, np.int64), np.zeros(d, np.int64)])
                own[0] += len(rows)
                own[1] += (points >> _LOW).sum(axis=0)
                own[2] += (points & ((1 << _LOW) - 1)).sum(axis=0)
        for d, (n, high, low) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n, np.int64)),
                 pa.array(high), pa.array(low)], ["dim", "place", "n", "high", "low"])

    parts = vectors.select("vector").mapInArrow(scan, "dim int, place int, n long, high long, low long")
    sums = written(parts.groupBy("dim", "place").agg(*(F.sum(c).alias(c) for c in ("n", "high", "low"))), "sums")
    most = sums.where("place = 0 AND n > 0").orderBy(F.desc("n"), F.desc("dim")).select("dim").first()
    if most is None:
        return 0, []
    found = sorted(sums.where(F.col("dim") == most["dim"]).collect(), key=lambda r: r["place"])  # a row a dimension
    return found[0]["n"], [(r["high"] << _LOW) + r["low"] for r in found]


def _centre(n: int, sums) -> tuple[np.ndarray, np.ndarray]:
    """The mean as whole numbers and what is left of it, both exact to double precision."""
    base = [s // n for s in sums]
    return np.array(base, np.int64), np.array([(s - b * n) / n for s, b in zip(sums, base)])


def _covariance(vectors: DataFrame, step: float, offset: int, n: int, sums: list[int]) -> np.ndarray:
    d, (base, rest) = len(sums), _centre(n, sums)

    def rows(total: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
        values = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(places) + 1) * d, d, dtype=np.int32)), pa.array(total.reshape(-1)))
        return pa.RecordBatch.from_arrays([pa.array(places.astype(np.int32)), values], ["place", "cells"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, _, points in _grids(batch, step, offset, d):
                centred = (points - base).astype(np.float64) - rest
                total = (0 if total is None else total) + centred.T @ centred
        if total is not None:
            yield rows(total, np.arange(d))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            cells = batch.column("cells").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for place, own in zip(batch.column("place").to_pylist(), cells):
                total[place] = total[place] + own if place in total else own.copy()
        if total:
            yield rows(np.stack(list(total.values())), np.array(list(total)))

    schema = "place int, cells array<double>"
    found = vectors.select("vector").mapInArrow(scan, schema).repartition("place").mapInArrow(add, schema).collect()  # d rows
    scatter = np.array([r["cells"] for r in sorted(found, key=lambda r: r["place"])])
    return (scatter + scatter.T) / (2 * n)


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower factor L, as many columns as the rank, and the order p: a[p][:, p] = L L'."""
    d = len(a)
    order, factor, left = np.arange(d), np.zeros((d, d)), a.diagonal().copy()
    least = d * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(d):
        pivot = k + int(np.argmax(left[k:]))
        if not left[pivot] > least:
            return factor[:, :k], order
        for rows in (order, factor, left):
            rows[[k, pivot]] = rows[[pivot, k]]
        factor[k, k] = math.sqrt(left[k])
        factor[k + 1:, k] = (a[order[k + 1:], order[k]] - factor[k + 1:, :k] @ factor[k, :k]) / factor[k, k]
        left[k + 1:] -= factor[k + 1:, k] ** 2
    return factor, order


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns rotated pairwise until all are orthogonal, by falling norm. Disjoint pairs
    are rotated together: a round-robin tournament meets every pair once a sweep."""
    g = factor.T.copy()  # a column is a row here
    r = len(g)
    ring = list(range(r + r % 2))  # with an odd number, the last one sits out
    close = len(factor) * np.finfo(float).eps
    for _ in range(_SWEEPS):
        rotated = False
        for _ in range(len(ring) - 1):
            pairs = [(a, b) for a, b in zip(ring[: len(ring) // 2], ring[::-1]) if max(a, b) < r]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            if not pairs:
                continue
            i, j = (np.array(x) for x in zip(*pairs))
            p, q = g[i], g[j]
            pp, qq, pq = (p * p).sum(1), (q * q).sum(1), (p * q).sum(1)
            size = np.sqrt(pp * qq)
            off = np.abs(pq) > close * size
            rotated |= bool(off.any())
            safe = np.where(off, pq, 1.0)
            zeta = (qq - pp) / (2 * safe)
            t = np.where(off, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            s = c * t
            g[i], g[j] = c[:, None] * p - s[:, None] * q, s[:, None] * p + c[:, None] * q
        if not rotated:
            break
    else:
        raise ArithmeticError(f"columns not orthogonal after {_SWEEPS} sweeps")
    return g[np.argsort(-(g * g).sum(1), kind="stable")].T


def principal(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues, falling, and their unit eigenvectors as columns; the largest
    entry of each is positive."""
    factor, order = pivoted_cholesky(covariance)
    rotated = one_sided_jacobi(factor)
    norms = np.sqrt((rotated * rotated).sum(0))
    vectors = np.empty_like(rotated)
    vectors[order] = rotated / norms
    if vectors.size:
        vectors *= np.where(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return norms**2, vectors


def fit(rows: DataFrame, column: str = "embedding", step: float = STEP, offset: int = OFFSET) -> Fit | None:
    """Mean and principal directions of the grid points; None without any usable vector."""
    vectors = rows.select(F.col(column).alias("vector"))
    n, sums = _sums(vectors, step, offset)
    if not n:
        return None
    covariance = _covariance(vectors, step, offset, n, sums)
    values, components = principal(covariance)
    return Fit(n, tuple(sums), values, components, float(covariance.trace()))


def transform(rows: DataFrame, found: Fit | None, key: str = "vec_id", column: str = "embedding", step: float = STEP,
              offset: int = OFFSET, top: int = TOP) -> DataFrame:
    """key, deviation (sum over dimensions of (n x - S)^2), whitened: the `top` first
    coordinates, each of variance 1. A row for every usable vector of the fitted dimension."""
    schema = "key long, deviation long, whitened array<double>"
    if found is None or not len(found.values):
        return rows.sparkSession.createDataFrame([], schema)
    n, d = found.n, len(found.sums)
    base, rest = _centre(n, found.sums)
    turn = found.components[:, :top] / np.sqrt(found.values[:top])
    k = turn.shape[1]
    wrapped = np.array([s & ((1 << 64) - 1) for s in found.sums], np.uint64).view(np.int64)
    sums = found.sums

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, at, points in _grids(batch, step, offset, d):
                centred = (points - base).astype(np.float64) - rest
                away = points * np.int64(n) - wrapped  # modulo 2^64, right wherever the sum of squares fits a long
                deviation = (away * away).sum(axis=1)
                large = np.flatnonzero(((n * centred) ** 2).sum(axis=1) > 9e18)
                exact = {int(r): sum((n * x - s) ** 2 for x, s in zip(points[r].tolist(), sums)) for r in large}
                fits = np.ones(len(at), bool)
                for r, total in exact.items():
                    fits[r] = total < 1 << 63
                    deviation[r] = total if fits[r] else 0
                values = pa.array((centred @ turn).reshape(-1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(at)), pa.array(deviation, mask=~fits),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, (len(at) + 1) * k, k, dtype=np.int32)), values)],
                    ["key", "deviation", "whitened"])

    return _vectors(rows, key, column).mapInArrow(project, schema)


def identity_error(whitened: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of k whitened coordinates minus the identity."""
    at = [F.get("whitened", F.lit(i)) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    means = whitened.agg(F.count("*").alias("n"), *(F.avg(c).alias(f"m{i}") for i, c in enumerate(at))).first()
    if not means["n"]:
        return 0.0
    centred = [c - F.lit(means[f"m{i}"]) for i, c in enumerate(at)]
    found = whitened.agg(*(F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def op12(embeddings: DataFrame) -> DataFrame:
    found = fit(embeddings)
    whitened = transform(embeddings, found)
    k = min(TOP, len(found.values)) if found else 0
    shares = [float(e) / found.trace for e in found.values[:k]] if k else []
    if k:
        whitened = written(whitened, "whitened")
    error = identity_error(whitened, k) if k else 0.0
    return whitened.select(F.col("key").alias("vec_id"), "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(found.n if found else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.lit(shares) if k else F.array().cast("array<double>"), F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
