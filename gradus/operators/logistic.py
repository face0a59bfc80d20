"""Logistic regression on wide normalised columns."""

from __future__ import annotations

import math
from collections.abc import Generator, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.operators.gram import sum_of_parts
from gradus.operators.linear import LinearModel, normal_two_sided
from gradus.operators.prep import CONSTANT_TERM

# Directions with less than this share of the largest curvature count as collinear.
FLAT = 1e-12

# Curvature counts as bent in every direction if no direction has less than this share.
FULL = 1e-9

# A step that lowers the likelihood is halved so many times at most.
HALVINGS = 10

# Rows of a block, and numbers it holds at most. Batches of blocks are bounded in bytes by Spark.
BLOCK, BLOCK_NUMBERS = 1 << 13, 1 << 18

_BLOCKS = "n int, lacks boolean, x binary, y binary, marks binary"


@dataclass(frozen=True)
class LogisticFit:
    """One fit among several on the same rows: its features and the rows it reads (all if none is named).

    Steps begin at ``start``, coefficients by name, if given, else at zero.
    """

    features: tuple[str, ...]
    flag: str | None = None
    constant: bool = True
    start: Mapping[str, float] | None = None


@dataclass(frozen=True)
class _Sums:
    """Rows, positives, log likelihood, gradient and curvature at some coefficients."""

    n: float
    positives: float
    likelihood: float
    slope: np.ndarray
    bend: np.ndarray


@dataclass(frozen=True)
class LogisticRows:
    """Rows with a label as blocks of numbers, held for any number of passes; missing features are not-a-number.

    A block is features by rows, so that a pass moves few large cells and converts no values.
    """

    features: tuple[str, ...]
    flags: tuple[str, ...]
    blocks: DataFrame
    tasks: int

    def release(self) -> None:
        self.blocks.unpersist()


def pack_rows(df: DataFrame, features: Sequence[str], label: str, flags: Sequence[str] = ()) -> LogisticRows:
    """Pack and hold the rows that have a label; the first pass over the blocks makes them.

    ``flags`` are boolean columns that fits may select rows by.
    """
    features, flags = tuple(features), tuple(flags)
    k = len(features)
    rows = df.select(
        *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
        F.col(label).cast("double").alias("_y"),
        *[F.coalesce(F.col(f), F.lit(False)).alias(f"s{i}") for i, f in enumerate(flags)],
    ).where(F.col("_y").isNotNull())
    size = max(1, min(BLOCK, BLOCK_NUMBERS // (k + 1)))

    def block(table: pa.Table) -> pa.RecordBatch:
        n = table.num_rows
        x, marks = np.empty((k, n)), np.empty((len(flags), n), bool)
        for i in range(k):
            x[i] = table.column(i).to_numpy()
        for i in range(len(flags)):
            marks[i] = table.column(k + 1 + i).to_numpy()
        cells = [x, table.column(k).to_numpy(), marks]
        return pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int32()), pa.array([bool(np.isnan(x).any())]), *(pa.array([c.tobytes()], pa.binary()) for c in cells)],
            [f.split()[0] for f in _BLOCKS.split(", ")],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                waiting.append(batch.slice(start, size - held))
                start, held = start + waiting[-1].num_rows, held + waiting[-1].num_rows
                if held == size:
                    yield block(pa.Table.from_batches(waiting))
                    waiting, held = [], 0
        if held:
            yield block(pa.Table.from_batches(waiting))

    blocks = rows.mapInArrow(pack, _BLOCKS).persist(StorageLevel.MEMORY_AND_DISK)
    return LogisticRows(features, flags, blocks, rows.rdd.getNumPartitions())


def _newton_sums(rows: LogisticRows, asked: list[tuple]) -> list[_Sums]:
    """The sums of several fits in one pass; each asks by (columns, flag, coefficients, shift).

    Coefficients travel with the task function and not in the plan, so that every pass has
    the same plan.
    """
    k, flags = len(rows.features), len(rows.flags)
    uppers = [np.triu_indices(len(at) + 1) for at, *_ in asked]
    sizes = [3 + len(at) + 1 + len(upper[0]) for (at, *_), upper in zip(asked, uppers)]

    def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total, any_row = [np.zeros(size) for size in sizes], False
        for batch in batches:
            for row in range(batch.num_rows):
                any_row = True
                n, lacks = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                every, y_all, marks = (batch.column(c)[row].as_buffer() for c in (2, 3, 4))
                every = np.frombuffer(every, float).reshape(k, n) if k else np.zeros((0, n))
                y_all = np.frombuffer(y_all, float)
                marks = np.frombuffer(marks, bool).reshape(flags, n) if flags else None
                for place, (at, flag, coef, shift) in enumerate(asked):
                    values, y = every if np.array_equal(at, np.arange(k)) else every[at], y_all
                    inside = None if flag is None else marks[flag]
                    if lacks:
                        known = ~np.isnan(values).any(axis=0)
                        inside = known if inside is None else inside & known
                    if inside is not None and not inside.all():
                        chosen = np.flatnonzero(inside)
                        values, y = values.take(chosen, axis=1), y.take(chosen)
                    x = np.empty((len(at) + 1, len(y)))
                    x[0] = 1.0
                    np.subtract(values, shift[:, None], out=x[1:])
                    score = coef @ x
                    # One exponential serves the probability and the likelihood, without overflow on either side.
                    small = np.exp(-np.abs(score))
                    p = np.where(score >= 0, 1.0, small) / (1.0 + small)
                    likelihood = (y * score - np.maximum(score, 0.0) - np.log1p(small)).sum()
                    bend = (x * (p * (1.0 - p))) @ x.T
                    total[place] += np.concatenate([[len(y), y.sum(), likelihood], x @ (y - p), bend[uppers[place]]])
        return np.concatenate(total) if any_row else None

    cells, found, start = sum_of_parts(rows.blocks, part, sum(sizes), rows.tasks), [], 0
    for (at, *_), upper, size in zip(asked, uppers, sizes):
        own, start, m = cells[start : start + size], start + size, len(at)
        bend = np.zeros((m + 1, m + 1))
        bend[upper] = own[4 + m :]
        found.append(_Sums(own[0], own[1], own[2], own[3 : 4 + m], bend + np.triu(bend, 1).T))
    return found


def _inverse(bend: np.ndarray) -> np.ndarray:
    """Pseudo-inverse after scaling to a unit diagonal; covers collinear and constant columns."""
    scale = np.sqrt(np.diag(bend))
    scale[scale <= 0] = 1.0
    return np.linalg.pinv(bend / np.outer(scale, scale), rcond=FLAT, hermitian=True) / np.outer(scale, scale)


def _full_rank(bend: np.ndarray) -> bool:
    """Whether the curvature bends in every direction, so that only one point is the best."""
    scale = np.sqrt(np.diag(bend))
    return bool((scale > 0).all()) and float(np.linalg.eigvalsh(bend / np.outer(scale, scale))[0]) > FULL


def _newton(
    plain: Sequence[str], constant: bool, max_iter: int, tol: float, start: Mapping[str, float] | None = None
) -> Generator[tuple, _Sums, LinearModel]:
    """The steps of one fit: asks for sums at (coefficients, shift), is sent them, and returns the model."""
    k = len(plain)
    used = slice(None) if constant else slice(1, None)
    at, shift = np.zeros(k + 1), np.zeros(k)
    if start:
        at[:] = [start.get(CONSTANT_TERM, 0.0) if constant else 0.0, *(start.get(f, 0.0) for f in plain)]
    now = yield at, shift
    if not 0 < now.positives < now.n:
        raise ValueError("logistic regression needs both classes")
    mean = now.bend[0, 1:] / now.bend[0, 0]
    settled = False
    for _ in range(max_iter):
        step = np.zeros(k + 1)
        step[used] = _inverse(now.bend[used, used]) @ now.slope[used]
        if constant and shift is not mean:
            at[0], step[0] = at[0] + at[1:] @ mean, step[0] + step[1:] @ mean
            shift = mean
        for _ in range(HALVINGS):
            found = yield at + step, shift
            if found.likelihood >= now.likelihood - 1e-12 * abs(now.likelihood):
                break
            step = step / 2
        at, now = at + step, found
        if np.abs(step).max() <= tol * max(1.0, np.abs(at).max()):
            settled = _full_rank(now.bend[used, used])
            break
    covariance = np.zeros((k + 1, k + 1))
    covariance[used, used] = _inverse(now.bend[used, used])
    spread = np.diag(covariance).copy()
    if constant:
        back = np.concatenate([[1.0], -shift])
        spread[0] = back @ covariance @ back
        at[0] -= at[1:] @ shift
    fitted = {f: (float(b), float(v)) for f, b, v in zip([CONSTANT_TERM, *plain], at, spread)}
    if not constant:
        del fitted[CONSTANT_TERM]
    names = tuple(sorted(fitted))
    p_values = tuple(normal_two_sided(b / math.sqrt(v)) if v > 0 else None for b, v in map(fitted.get, names))
    return LinearModel(names, tuple(fitted[f][0] for f in names), p_values, settled=settled)


def _plain(fits: Sequence[LogisticFit]) -> list[list[str]]:
    """The columns that each fit reads, in name order."""
    plain = [sorted(f for f in fit.features if f != CONSTANT_TERM) for fit in fits]
    if any(not names and not fit.constant for names, fit in zip(plain, fits)):
        raise ValueError("a fit without a constant needs a feature")
    return plain


def logreg_train_many(
    df: DataFrame, fits: Sequence[LogisticFit], label: str, max_iter: int = 20, tol: float = 1e-7
) -> list[LinearModel]:
    """Logistic regressions on several samples and feature sets of the same rows, as ``logreg_train`` does each.

    All fits take their next step in the same pass, so there are as many passes as the longest
    fit has steps, however many fits there are. A fit whose ``flag`` names a boolean column reads
    the rows where it is true; rows that lack one of its features or the label are left out.
    """
    every = sorted({f for names in _plain(fits) for f in names})
    flags = sorted({fit.flag for fit in fits if fit.flag})
    if flags and all(fit.flag for fit in fits):
        df = df.where(reduce(lambda a, b: a | b, [F.coalesce(F.col(f), F.lit(False)) for f in flags]))
    rows = pack_rows(df, every, label, flags)
    try:
        return logreg_fit_packed(rows, fits, max_iter, tol)
    finally:
        rows.release()


def logreg_fit_packed(
    rows: LogisticRows, fits: Sequence[LogisticFit], max_iter: int = 20, tol: float = 1e-7
) -> list[LinearModel]:
    """``logreg_train_many`` on rows that are packed already, with at least the features and flags of the fits."""
    plain = _plain(fits)
    running = {n: _newton(names, fit.constant, max_iter, tol, fit.start) for n, (names, fit) in enumerate(zip(plain, fits))}
    asked = {n: next(fit) for n, fit in running.items()}
    done: dict[int, LinearModel] = {}
    while asked:
        order = sorted(asked)
        wanted = [
            (
                np.array([rows.features.index(f) for f in plain[n]], int),
                rows.flags.index(fits[n].flag) if fits[n].flag else None,
                *asked[n],
            )
            for n in order
        ]
        for n, sums in zip(order, _newton_sums(rows, wanted)):
            try:
                asked[n] = running[n].send(sums)
            except StopIteration as end:
                done[n] = end.value
                del asked[n]
    return [done[n] for n in range(len(fits))]


def logreg_train(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    constant: bool = True,
    max_iter: int = 20,
    tol: float = 1e-7,
) -> LinearModel:
    """Logistic regression by Newton steps, with Wald p-values, for any number of columns.

    A step is one pass that adds up gradient and curvature. The first one also
    finds the means, which later steps subtract where there is a constant, so
    that large offsets lose no digits. A step that lowers the likelihood is
    halved. Steps shrink quadratically, so after one below ``tol`` the next would
    be below its square. Rows with a missing feature or label are left out.
    """
    if not set(features) - {CONSTANT_TERM}:
        return _intercept_only(df.select(F.col(label).cast("double").alias("_y")).where(F.col("_y").isNotNull()))
    return logreg_train_many(df, [LogisticFit(tuple(features), None, constant)], label, max_iter, tol)[0]


def _intercept_only(target: DataFrame) -> LinearModel:
    n, mean = target.agg(F.count("_y"), F.avg("_y")).first()
    if not n or mean in (0.0, 1.0):
        raise ValueError("logistic regression needs both classes")
    level = math.log(mean / (1 - mean))
    return LinearModel((CONSTANT_TERM,), (level,), (normal_two_sided(level * math.sqrt(n * mean * (1 - mean))),))
