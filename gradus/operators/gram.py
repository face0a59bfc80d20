"""Cross-product matrix of many columns in one distributed pass.

Tasks add up X'X of their Arrow batches with dense linear algebra and emit one
packed triangle each. Further steps fold those in levels into a fixed number of
partial sums, so the driver receives at most ``MERGERS`` triangles of k·(k+1)/2 numbers,
or ``DRIVER_NUMBERS`` numbers if that is more.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MERGERS = 8

# Numbers that the driver adds up itself, before partial sums are folded in tasks.
DRIVER_NUMBERS = 4 << 20

_PARTIAL = "cells array<double>"

# Rows whose first values stand for the size of a column.
SHIFT_ROWS = 64

# A mean this many deviations off its shift costs digits, so that sums are taken once more from the mean.
FAR_OFF = 1e5

# Deviations below this share of a column's size are rounding.
ROUNDING = 1e-13


@dataclass(frozen=True)
class Gram:
    """Count, mean and centred cross products of the named columns."""

    names: tuple[str, ...]
    n: float
    mean: np.ndarray
    cross: np.ndarray

    def index(self, names: Sequence[str]) -> list[int]:
        return [self.names.index(c) for c in names]

    def correlation(self, names: Sequence[str]) -> np.ndarray:
        """Correlation matrix; not-a-number where a column does not vary."""
        at = self.index(names)
        block = self.cross[np.ix_(at, at)]
        scale = np.sqrt(np.diag(block))
        with np.errstate(divide="ignore", invalid="ignore"):
            return block / np.outer(scale, scale)


def _pack(cells: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([cells], pa.list_(pa.float64()))], ["cells"])


def sum_of_parts(
    df: DataFrame,
    part: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None],
    size: int,
    tasks: int | None = None,
) -> np.ndarray:
    """Sum of the vectors that ``part`` makes of each partition's batches.

    Folded in levels: no task adds up more than about the root of the number of tasks.
    The driver adds up few and short vectors as they are. ``tasks`` is the number of
    partitions, if known.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = part(batches)
        if cells is not None:
            yield _pack(cells)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, any_row = np.zeros(size), False
        for batch in batches:
            for vector in batch.column(0):
                cells += vector.values.to_numpy()
                any_row = True
        if any_row:
            yield _pack(cells)

    folded, tasks = df.mapInArrow(partial, _PARTIAL), tasks or df.rdd.getNumPartitions()
    if tasks > MERGERS * MERGERS:
        folded = folded.repartition(math.isqrt(tasks)).mapInArrow(fold, _PARTIAL)
        tasks = math.isqrt(tasks)
    if tasks > MERGERS and tasks * size > DRIVER_NUMBERS:
        folded = folded.repartition(MERGERS).mapInArrow(fold, _PARTIAL)
    total = np.zeros(size)
    for batch in folded.toArrow().to_batches():
        for vector in batch.column(0):
            total += vector.values.to_numpy()
    return total


def _shifts(df: DataFrame) -> np.ndarray:
    """A present value of each column among some rows, 0 where there is none.

    Sums of what is left over such a value keep their digits, and are exactly 0 for a
    column that does not vary.
    """
    seen = df.limit(SHIFT_ROWS).toArrow()
    firsts = [c.drop_null() for c in seen.columns]
    return np.array([float(c[0].as_py()) if len(c) else 0.0 for c in firsts])


def _far(drift: np.ndarray, variance: np.ndarray, shift: np.ndarray) -> bool:
    """Whether a mean lies so far off its shift that the variance has lost its digits."""
    off = np.abs(drift) > np.maximum(FAR_OFF * np.sqrt(np.maximum(variance, 0.0)), ROUNDING * np.abs(shift))
    return bool(off.any())


@dataclass(frozen=True)
class Moments:
    """Counts, means and sums of squares around them of columns with missing values.

    ``products`` are the sums over the rows that have both columns, around their means; that
    is the cross product of the columns once missing values are replaced by the mean.
    """

    names: tuple[str, ...]
    n: float
    count: np.ndarray
    mean: np.ndarray
    squares: np.ndarray
    products: np.ndarray | None

    def deviation(self) -> np.ndarray:
        """Sample deviations; not-a-number below two values, 0 where there is only rounding."""
        with np.errstate(divide="ignore", invalid="ignore"):
            found = np.sqrt(np.where(self.count > 1, self.squares / (self.count - 1), np.nan))
        return np.where(found <= ROUNDING * np.abs(self.mean), 0.0, found)

    def scaled(self, names: Sequence[str]) -> Gram:
        """Cross products of the named columns, imputed with their means and divided by their deviations."""
        at = [self.names.index(c) for c in names]
        scale = self.deviation()[at]
        cross = self.products[np.ix_(at, at)] / np.outer(scale, scale)
        return Gram(tuple(names), self.n, np.zeros(len(at)), cross)


def masked_moments(
    df: DataFrame, cols: Sequence[tuple[str, Column]], products: bool = True, shift: np.ndarray | None = None
) -> Moments:
    """Moments of columns with missing values, in one pass.

    Beside the sums of all rows, tasks add up products with the marks of missing values, for
    the columns that have any; these give the sums over the rows where two columns are
    present, and so means, deviations and the imputed cross products together.
    """
    names, k = tuple(n for n, _ in cols), len(cols)
    plain = df.select(*[e.cast("double").alias(f"x{i}") for i, (_, e) in enumerate(cols)])
    shift = _shifts(plain) if shift is None else shift
    upper = np.triu_indices(k)
    size = 1 + 3 * k + (2 * len(upper[0]) + k * k if products else 0)

    def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        n, sums, lacks, squares = 0, np.zeros(k), np.zeros(k), np.zeros(k)
        both, mixed, absent = (np.zeros((k, k)) if products else None for _ in range(3))
        for batch in batches:
            if not batch.num_rows:
                continue
            n += batch.num_rows
            x = np.empty((batch.num_rows, k))
            for i in range(k):
                x[:, i] = batch.column(i).to_numpy(zero_copy_only=False)
            x -= shift
            some = [i for i in range(k) if batch.column(i).null_count]
            if some:
                missing = np.column_stack([batch.column(i).is_null().to_numpy(zero_copy_only=False) for i in some])
                x[:, some] = np.where(missing, 0.0, x[:, some])
                missing = missing.astype(float)
                lacks[some] += missing.sum(axis=0)
                if products:
                    mixed[:, some] += x.T @ missing
                    absent[np.ix_(some, some)] += missing.T @ missing
            sums += x.sum(axis=0)
            if products:
                both += x.T @ x
            else:
                squares += (x * x).sum(axis=0)
        if not n:
            return None
        if not products:
            return np.concatenate([[n], sums, lacks, squares])
        return np.concatenate([[n], sums, lacks, np.diag(both), both[upper], mixed.ravel(), absent[upper]])

    cells = sum_of_parts(plain, part, size)
    n, sums, lacks, squares = cells[0], cells[1 : 1 + k], cells[1 + k : 1 + 2 * k], cells[1 + 2 * k : 1 + 3 * k]
    count = n - lacks
    with np.errstate(divide="ignore", invalid="ignore"):
        drift = np.where(count > 0, sums / count, np.nan)
        variance = np.where(count > 0, squares / count, np.nan) - drift * drift
    if _far(np.nan_to_num(drift), np.nan_to_num(variance), shift):
        if not np.allclose(shift, shift + np.nan_to_num(drift), rtol=1e-12, atol=0):
            return masked_moments(df, cols, products, shift + np.nan_to_num(drift))
    centred = np.maximum(squares - count * np.nan_to_num(drift) ** 2, 0.0)
    found = None
    if products:
        rest = cells[1 + 3 * k :]
        both, absent = np.zeros((k, k)), np.zeros((k, k))
        both[upper], absent[upper] = rest[: len(upper[0])], rest[len(upper[0]) + k * k :]
        both, absent = (m + np.triu(m, 1).T for m in (both, absent))
        # Sums of a column over the rows that have the other one, and the rows that have both.
        given = sums[:, None] - rest[len(upper[0]) : len(upper[0]) + k * k].reshape(k, k)
        shared = n - lacks[:, None] - lacks[None, :] + absent
        off = np.nan_to_num(drift)
        found = both - off[None, :] * given - off[:, None] * given.T + np.outer(off, off) * shared
        np.fill_diagonal(found, centred)
    return Moments(names, n, count, shift + drift, centred, found)


def gram_matrix(
    df: DataFrame, cols: Sequence[str | tuple[str, Column]], weight: Column | None = None, shift: np.ndarray | None = None
) -> Gram:
    """Cross products over the rows whose columns are all present.

    ``cols`` are column names or (name, expression) pairs. One pass: columns are shifted by
    one of their values, or by ``shift``, so large offsets lose no digits; where that value
    turns out to lie far off the others, the pass is made again from the mean.
    """
    named = [(c, F.col(c)) if isinstance(c, str) else c for c in cols]
    names = tuple(n for n, _ in named)
    k = len(names)
    plain = df.select(
        *[e.cast("double").alias(f"x{i}") for i, (_, e) in enumerate(named)],
        (F.lit(1.0) if weight is None else weight.cast("double")).alias("w"),
    ).dropna()
    if shift is None:
        shift = _shifts(plain.select(*[f"x{i}" for i in range(k)]))
    upper = np.triu_indices(k + 1)

    def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total, n = np.zeros((k + 1, k + 1)), 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(k + 1)]
            x = np.empty((batch.num_rows, k + 1))
            x[:, 0] = 1.0
            x[:, 1:] = np.column_stack(columns[:k]) - shift
            total += x.T @ (x * columns[k][:, None])
            n += batch.num_rows
        return np.append(total[upper], n) if n else None

    *cells, rows = sum_of_parts(plain, part, len(upper[0]) + 1)
    total, rows = np.zeros((k + 1, k + 1)), float(rows)
    total[upper] = cells
    total = total + np.triu(total, 1).T
    mass = total[0, 0]
    if not rows:
        return Gram(names, 0.0, np.full(k, np.nan), np.full((k, k), np.nan))
    drift = total[0, 1:] / mass
    variance = np.diag(total)[1:] / mass - drift * drift
    if _far(drift, variance, shift) and not np.allclose(shift, shift + drift, rtol=1e-12, atol=0):
        return gram_matrix(df, cols, weight, shift + drift)
    cross = total[1:, 1:] - mass * np.outer(drift, drift)
    n = rows if weight is None else mass
    return Gram(names, n, shift + drift, cross)
