"""Whitening of embeddings by a pivoted Cholesky factor and one-sided Jacobi rotations.

Entries become whole numbers, so sums and deviations are exact. Tasks add up the
scatter of the distinct vectors around their mean; the driver factors it with
pivoting and rotates the columns of the factor until they are orthogonal. Their
squared norms are then the eigenvalues, the columns themselves the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.llm.base import materialise
from gradus.operators.gram import sum_of_parts

# An entry c becomes floor(SCALE * c) + SHIFT. Fixed values.
SCALE, SHIFT = 64, 1_000_000

COMPONENTS = 16

# Entries beyond this have no exact whole number in a double and count as not finite.
LARGEST = float(1 << 52) / SCALE

# Halves of a whole number whose sums over any table fit 64 bits.
HALF = 26

_SWEEPS = 60


@dataclass(frozen=True)
class Whitening:
    """What a fit knows: rows, exact sums, eigenvalues, components (as columns), shares, measured error."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        return _centre(self.n, self.sums)


def _centre(n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as whole part and remainder, so that no digits are lost in subtracting it."""
    whole = np.array([s // n for s in sums], np.int64)
    return whole, np.array([s % n for s in sums], np.int64)


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Ids and vectors of whole numbers (``x``) of the rows whose entries are all present and finite."""
    rows = vectors.select(F.col(id_col), F.col(column).cast("array<double>").alias("_v")).where("_v IS NOT NULL")
    finite = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)))
    whole = F.transform("_v", lambda c: F.floor(c * F.lit(float(SCALE))).cast("long") + F.lit(SHIFT).cast("long"))
    rows = rows.where(F.coalesce(finite, F.lit(False))).select(id_col, whole.alias("x"))
    usual = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == F.lit(usual["d"] if usual else -1))


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of equal lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _sums(distinct: DataFrame, d: int) -> tuple[int, tuple[int, ...]]:
    """Number of rows and exact sums of the dimensions."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                n += len(x)
                high += (x >> HALF).sum(0)
                low += (x & ((1 << HALF) - 1)).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, d), pa.int64()), pa.array(np.append(n, high)), pa.array(np.append(0, low))],
                ["at", "high", "low"],
            )

    found = distinct.select("x").mapInArrow(part, "at long, high long, low long").groupBy("at")
    wide = "decimal(38,0)"
    rows = found.agg(F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low")).collect()
    by_place = {r["at"]: (int(r["high"]), int(r["low"])) for r in rows}
    if not by_place:
        return 0, ()
    return by_place[-1][0], tuple((by_place[k][0] << HALF) + by_place[k][1] for k in range(d))


def _second_moments(distinct: DataFrame, size: int, of_rows) -> np.ndarray:
    """Sum over the rows of the outer products of ``of_rows(x)``."""
    upper = np.triu_indices(size)

    def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total, any_row = np.zeros((size, size)), False
        for batch in batches:
            if batch.num_rows:
                z, any_row = of_rows(_matrix(batch.column(0))), True
                total += z.T @ z
        return total[upper] if any_row else None

    total = np.zeros((size, size))
    total[upper] = sum_of_parts(distinct.select("x"), part, len(upper[0]))
    return total + np.triu(total, 1).T


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """A factor g with a = g g', its columns in the order of the pivots, as many as the rank.

    In the order of the pivots its rows form a lower triangle.
    """
    d = len(a)
    g, rest = np.zeros((d, d)), np.diag(a).astype(float).copy()
    least = d * np.finfo(float).eps * max(rest.max(initial=0.0), 0.0)
    for k in range(d):
        at = int(rest.argmax())
        if rest[at] <= least:
            return g[:, :k]
        column = (a[:, at] - g[:, :k] @ g[at, :k]) / np.sqrt(rest[at])
        column[rest == -np.inf] = 0.0  # rows of earlier pivots: above the diagonal
        column[at] = np.sqrt(rest[at])
        g[:, k] = column
        rest = rest - column * column
        rest[at] = -np.inf
    return g


def _rounds(count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of columns such that every two meet once; the pairs of a round share no column."""
    ring = list(range(count + count % 2))
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(a, b) for a, b in zip(ring[:half], ring[half:][::-1]) if a < count and b < count]
        yield np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(g: np.ndarray) -> np.ndarray:
    """The columns of g, rotated in pairs until all are orthogonal; longest first."""
    g = g.copy()
    close = np.finfo(float).eps * max(1, len(g)) ** 0.5
    for _ in range(_SWEEPS):
        turned = False
        for a, b in _rounds(g.shape[1]):
            p, q = g[:, a], g[:, b]
            alpha, beta, gamma = (p * p).sum(0), (q * q).sum(0), (p * q).sum(0)
            turn = np.abs(gamma) > close * np.sqrt(alpha * beta)
            if not turn.any():
                continue
            turned = True
            zeta = (beta - alpha) / np.where(turn, 2 * gamma, 1.0)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(turn, t, 0.0)
            c = 1 / np.sqrt(1 + t * t)
            g[:, a], g[:, b] = c * p - c * t * q, c * t * p + c * q
        if not turned:
            break
    return g[:, np.argsort(-(g * g).sum(0), kind="stable")]


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on each distinct vector of ``whole_vectors`` once; None without rows that vary.

    The driver holds the scatter, so a vector has some thousand dimensions at most.
    """
    distinct = materialise(rows.select("x").distinct())
    first = distinct.first()
    if first is None or not len(first["x"]):
        return None
    d = len(first["x"])
    n, sums = _sums(distinct, d)
    whole, rest = _centre(n, sums)
    fraction = rest / n

    scatter = _second_moments(distinct, d, lambda x: (x - whole) - fraction)
    turned = one_sided_jacobi(pivoted_cholesky(scatter))[:, :components]
    squares = (turned * turned).sum(0)
    turned, squares = turned[:, squares > 0], squares[squares > 0]
    if not squares.size:
        return None
    vectors, values = turned / np.sqrt(squares), squares / n

    onto = vectors / np.sqrt(values)
    again = _second_moments(distinct, len(values), lambda x: ((x - whole) - fraction) @ onto)
    error = float(np.abs(again / n - np.eye(len(values))).max())
    return Whitening(n, sums, values, vectors, squares / np.trace(scatter), error)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Exact sums of (n * x - sum) squared; None beyond 64 bits."""
    whole, rest = _centre(n, sums)
    near = x - whole
    reach = n * (int(np.abs(near).max(initial=0)) + 1)
    if x.shape[1] * reach * reach < 1 << 63:
        off = n * near - rest
        return (off * off).sum(1).tolist()
    off = near.astype(object) * n - rest.astype(object)
    return [v if v < 1 << 63 else None for v in (off * off).sum(1).tolist()]


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened components of every vector.

    Returns for each row that is used one row per component: vec_id, component (from 1,
    by falling eigenvalue), n (distinct vectors of the fit), deviation (exact sum of
    (n * x - sum) squared), whitened, explained (share of the variance) and identity_error
    (one value: how far the covariance of the whitened fit is from the identity, at most).

    Nulls and edges: rows whose vector is null, or has a null, non-finite or larger entry
    than ``LARGEST``, are left out, and so are rows of another length than most (of equally
    frequent lengths the longer counts). Repeated vectors count once in the fit and are each
    returned, as are rows with a null or repeated vec_id. Components without variance are
    not returned, so equal vectors only, empty vectors and an empty table give no rows. A
    deviation that no long holds is null. Further columns, also ones named like the
    result's, are not read.
    """
    rows = whole_vectors(vectors)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    fitted = fit_whitening(rows, components)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    whole, rest = fitted.centre()
    fraction, onto = rest / fitted.n, fitted.vectors / np.sqrt(fitted.values)
    k = len(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            found = ((x - whole) - fraction) @ onto
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, fitted.n, np.int64)),
                    pa.array(_deviations(x, fitted.n, fitted.sums), pa.int64()).take(pa.array(each)),
                    pa.array(found.reshape(-1)),
                    pa.array(np.tile(fitted.explained, len(x))),
                    pa.array(np.full(len(x) * k, fitted.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)


__all__ = ["Whitening", "fit_whitening", "one_sided_jacobi", "pivoted_cholesky", "whiten", "whole_vectors"]
