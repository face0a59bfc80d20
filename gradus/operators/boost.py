"""Gradient boosting with second-order gains, by histograms that tasks add up.

Features are cut into bins at weighted quantiles; rows become blocks of bin numbers. For
each level of a round's trees one pass over the blocks adds up gradients and hessians by
class, node, feature and bin, and the driver picks the splits. Missing values have a bin of
their own and go to the side with the greater gain. Gradients are counted in whole
multiples of a small unit, so sums are exact and a fit does not depend on partitions, their
order, or tasks that run again.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.operators.ensemble import Ensemble, Tree, probabilities
from gradus.operators.gram import sum_of_parts
from gradus.operators.prep import as_double
from gradus.operators.sketch import ROWS as SKETCH_ROWS
from gradus.operators.sketch import sketch_columns
from gradus.session import drop_path, materialise_at

# Parts that a feature is cut into, at most; missing values come beside them.
BINS = 128

# Rows of a block.
BLOCK = 1 << 13

# Bytes of the blocks of one partition. A task gets them as one batch, since few rows hold much.
TASK_BYTES = 16 << 20

# Numbers of a histogram that one pass adds up. Levels with more take several passes.
HISTOGRAM_NUMBERS = 1 << 21

# Rounds after which the margins of the rows are written down.
CHECKPOINT_ROUNDS = 10

# Gains up to this are none, and hessians are at least as large.
LEAST_GAIN, LEAST_HESSIAN = 1e-6, 1e-16

# Bits of the largest sum; doubles add whole numbers up to 53 exactly.
SUM_BITS = 51

_BLOCKS = "n int, key binary, y binary, w binary, bins binary, margin binary"


@dataclass(frozen=True)
class BoostSettings:
    """Parameters by their usual names."""

    learning_rate: float = 0.1
    max_depth: int = 3
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    min_child_weight: float = 1.0
    n_estimators: int = 100
    gamma: float = 0.0
    reg_lambda: float = 1.0
    seed: int = 42

    @classmethod
    def of(cls, params: Mapping, seed: int) -> BoostSettings:
        kinds = {"max_depth": int, "n_estimators": int}
        known = {name for name in cls.__dataclass_fields__ if name != "seed"}
        if unknown := sorted(set(params) - known):
            raise ValueError(f"unknown tree parameters: {unknown}")
        return cls(**{k: kinds.get(k, float)(v) for k, v in params.items()}, seed=seed)


@dataclass
class BinnedRows:
    """Blocks of rows with their cuts, ready for any number of fits."""

    features: tuple[str, ...]
    n_classes: int
    cuts: tuple[np.ndarray, ...]
    blocks: DataFrame
    tasks: int
    weight: float

    @property
    def bins(self) -> int:
        """Bins of each feature, the missing one (the last) included."""
        return 2 + max((len(c) for c in self.cuts), default=0)

    @property
    def margins(self) -> int:
        return 1 if self.n_classes == 2 else self.n_classes

    def release(self) -> None:
        self.blocks.unpersist()


def _bin_type(bins: int) -> type:
    return np.uint8 if bins <= 256 else np.uint16


def bin_rows(
    df: DataFrame, id_col: str, features: Sequence[str], y: Column, weight: Column, n_classes: int,
    bins: int = BINS, sketch_rows: int = SKETCH_ROWS,
) -> BinnedRows:
    """Cut the features into bins and hold the rows as blocks.

    ``y`` is the number of the class, ``weight`` a row's weight; rows with a null in either, or
    without weight, are left out. Rows are told apart by a hash of id and features.
    """
    features = tuple(features)
    values = [as_double(df, f) for f in features]
    rows = df.select(
        F.xxhash64(F.col(id_col), *values).alias("key"),
        y.cast("int").alias("y"),
        weight.cast("double").alias("w"),
        *[v.alias(f"x{k}") for k, v in enumerate(values)],
    ).where("y IS NOT NULL AND w > 0")
    n, total = rows.agg(F.count("*"), F.sum("w")).first()
    if not n:
        raise ValueError("no training rows")
    names = [F.col(f"x{k}") for k in range(len(features))]
    sketch = sketch_columns(rows, names, F.col("key"), F.col("w"), n, total, sketch_rows)
    cuts = tuple(sketch.cuts(k, bins) for k in range(len(features)))
    held = BinnedRows(features, n_classes, cuts, rows, 0, float(total))
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()
    if parts < cores and n > BLOCK:
        rows = rows.repartition(cores)
        parts = cores
    missing, kind, m = held.bins - 1, _bin_type(held.bins), len(features)

    def block(table: pa.Table) -> pa.RecordBatch:
        n = table.num_rows
        out = np.empty((m, n), kind)
        for k in range(m):
            x = table.column(3 + k).to_numpy().astype(float)
            out[k] = np.where(np.isnan(x), missing, np.searchsorted(cuts[k], x, side="right"))
        cells = [
            table.column("key").to_numpy(), table.column("y").to_numpy().astype(np.int32),
            table.column("w").to_numpy(), out,
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in cells), pa.array([b""], pa.binary())],
            [f.split()[0] for f in _BLOCKS.split(", ")],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                waiting.append(batch.slice(start, BLOCK))
                size += waiting[-1].num_rows
                if size >= BLOCK:
                    yield block(pa.Table.from_batches(waiting))
                    waiting, size = [], 0
        if size:
            yield block(pa.Table.from_batches(waiting))

    blocks = rows.mapInArrow(pack, _BLOCKS)
    block_bytes = BLOCK * (20 + m * np.dtype(kind).itemsize + 8 * held.margins)
    wanted = -(-n // (BLOCK * max(1, TASK_BYTES // block_bytes)))
    if wanted > parts:
        blocks, parts = blocks.repartition(wanted), wanted
    held.blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    held.blocks.select("n").agg(F.sum("n")).first()
    held.tasks = parts
    return held


@dataclass(frozen=True)
class _Growing:
    """A tree over bins; leaves that may still split have ``feature`` -2."""

    class_at: int
    used: np.ndarray  # features drawn for the tree
    feature: list
    at: list  # bins up to this one go left
    missing_left: list
    left: list
    right: list
    grad: list
    hess: list
    gain: list

    def leaves(self, bins: np.ndarray, missing: int) -> np.ndarray:
        """The leaf of every row of a block of bins (features by rows)."""
        feature, at = np.array(self.feature), np.array(self.at)
        side, left, right = np.array(self.missing_left), np.array(self.left), np.array(self.right)
        where = np.zeros(bins.shape[1], np.int32)
        moving = np.arange(bins.shape[1]) if feature[0] >= 0 else np.zeros(0, int)
        while moving.size:
            node = where[moving]
            value = bins[feature[node], moving]
            goes = np.where(value == missing, side[node], value <= at[node])
            where[moving] = np.where(goes, left[node], right[node])
            moving = moving[feature[where[moving]] >= 0]
        return where


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit hashes of 64-bit numbers."""
    z = numbers + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _drawn(keys: np.ndarray, seed: int, round_: int, share: float) -> np.ndarray:
    """Which rows a round reads, by a hash of row, seed and round."""
    salt = int.from_bytes(hashlib.md5(f"{seed}:{round_}".encode()).digest()[:8], "little")
    with np.errstate(over="ignore"):
        mixed = _mixed(keys.view(np.uint64) ^ np.uint64(salt))
    return (mixed >> np.uint64(11)) < np.uint64(int(share * (1 << 53)))


def _drawn_features(names: Sequence[str], seed: int, round_: int, class_at: int, share: float) -> np.ndarray:
    """Features of a tree: the ones with the least hashes of name, seed, round and class."""
    count = max(1, int(share * len(names)))
    order = sorted(range(len(names)), key=lambda k: hashlib.md5(f"{seed}:{round_}:{class_at}:{names[k]}".encode()).digest())
    return np.array(sorted(order[:count]), int)


def _gradients(margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted first and second derivatives of the loss by margin (rows by margins)."""
    p = probabilities(margin)
    if margin.shape[1] == 1:
        p = p[:, 1:]
        grad, hess = p - (y == 1)[:, None], p * (1 - p)
    else:
        grad, hess = p - (y[:, None] == np.arange(margin.shape[1])), 2 * p * (1 - p)
    return grad * w[:, None], np.maximum(hess, LEAST_HESSIAN) * w[:, None]


class _Fit:
    """A fit in progress: the trees so far, and the rows with the margins of the first of them."""

    def __init__(self, rows: BinnedRows, settings: BoostSettings, checkpoint_rounds: int):
        self.rows, self.settings, self.checkpoint_rounds = rows, settings, checkpoint_rounds
        self.blocks, self.path, self.tasks = rows.blocks, None, rows.tasks
        self.rounds: list[list[_Growing]] = []
        self.written = 0  # rounds whose margins the blocks have
        self.unit = 2.0 ** (SUM_BITS - math.ceil(math.log2(max(rows.weight, 1e-300))))
        self.values: list[list[np.ndarray]] = []

    def _reader(self):
        """A function that reads a batch of blocks: keys, classes, weights, bins and margins now."""
        m, k, kind, missing = len(self.rows.features), self.rows.margins, _bin_type(self.rows.bins), self.rows.bins - 1
        recent = [(t, v) for trees, values in zip(self.rounds[self.written :], self.values[self.written :]) for t, v in zip(trees, values)]

        def read(batch: pa.RecordBatch) -> Iterator[tuple]:
            # Cells are read where they lie: a list of them would hold the batch twice.
            for row in range(batch.num_rows):
                n = batch.column(0)[row].as_py()
                key, y, w, bins, margin = (batch.column(c)[row].as_buffer() for c in range(1, 6))
                bins = np.frombuffer(bins, kind).reshape(m, n)
                now = np.frombuffer(margin, float).reshape(n, k).copy() if margin.size else np.zeros((n, k))
                for tree, value in recent:
                    now[:, tree.class_at] += value[tree.leaves(bins, missing)]
                yield np.frombuffer(key, np.int64), np.frombuffer(y, np.int32), np.frombuffer(w, float), bins, now

        return read

    def histograms(self, trees: list[_Growing], slots: list[tuple[int, int]]) -> np.ndarray:
        """Sums of gradients and hessians: slot (tree, node), feature drawn, bin, and which of the two."""
        read, settings, unit = self._reader(), self.settings, self.unit
        nb, missing, now = self.rows.bins, self.rows.bins - 1, len(self.rounds)
        drawn = len(trees[0].used)
        shape = (len(slots), drawn, nb, 2)
        of_tree = {}
        for number, (tree, node) in enumerate(slots):
            of_tree.setdefault(tree, []).append((node, number))

        def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            total = np.zeros(shape)
            for batch in batches:
                for key, y, w, bins, margin in read(batch):
                    grad, hess = _gradients(margin, y, w)
                    if settings.subsample < 1:
                        taken = _drawn(key, settings.seed, now, settings.subsample)
                        grad, hess, bins = grad[taken], hess[taken], bins[:, taken]
                    for t, nodes in of_tree.items():
                        tree = trees[t]
                        place = np.full(len(tree.feature), -1)
                        for node, number in nodes:
                            place[node] = number - nodes[0][1]
                        at = place[tree.leaves(bins, missing)]
                        inside = np.flatnonzero(at >= 0)
                        at = at[inside] * nb
                        g = np.rint(grad[inside, tree.class_at] * unit)
                        h = np.rint(hess[inside, tree.class_at] * unit)
                        first, count = nodes[0][1], len(nodes)
                        for f, feature in enumerate(tree.used):
                            cell = at + bins[feature, inside]
                            for which, of in enumerate((g, h)):
                                found = np.bincount(cell, weights=of, minlength=count * nb)
                                total[first : first + count, f, :, which] += found.reshape(count, nb)
            return total.reshape(-1)

        found = sum_of_parts(self.blocks, part, math.prod(shape), self.tasks)
        return found.reshape(shape) / unit

    def write_margins(self) -> None:
        """Write the rows with the margins of all rounds so far, in place of the copy before."""
        read = self._reader()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, (*_, now) in enumerate(read(batch)):
                    own = batch.slice(row, 1).columns[:5]
                    yield pa.RecordBatch.from_arrays([*own, pa.array([now.tobytes()], pa.binary())], batch.schema.names)

        before = self.path
        self.blocks, self.path = materialise_at(self.blocks.mapInArrow(run, _BLOCKS))
        self.tasks = self.blocks.rdd.getNumPartitions()
        self.written = len(self.rounds)
        if before:
            drop_path(self.blocks.sparkSession, before)

    def best(self, sums: np.ndarray, used: np.ndarray) -> list[tuple | None]:
        """For each slot the best split: feature, bin, missing left, gain, left and right sums."""
        s, out = self.settings, []
        counts = np.array([len(self.rows.cuts[f]) for f in used])
        whole = sums.sum(axis=2)[:, 0]
        below, absent = np.cumsum(sums[:, :, :-1], axis=2), sums[:, :, -1:]
        left = np.stack([below + absent, below], axis=3)  # missing to the left, to the right
        right = whole[:, None, None, None] - left
        # The cut after the last bin parts present from missing values.
        valid = (np.arange(sums.shape[2] - 1) <= counts[:, None])[None, :, :, None]
        valid = valid & (left[..., 1] >= s.min_child_weight) & (right[..., 1] >= s.min_child_weight)
        valid &= (left[..., 1] > 0) & (right[..., 1] > 0)

        def worth(part: np.ndarray) -> np.ndarray:
            return part[..., 0] ** 2 / (part[..., 1] + s.reg_lambda)

        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(valid, worth(left) + worth(right) - worth(whole)[:, None, None, None], -np.inf)
        for slot in range(len(sums)):
            at = int(gain[slot].argmax())
            f, cut, side = np.unravel_index(at, gain[slot].shape)
            value = float(gain[slot][f, cut, side])
            if value <= max(s.gamma, LEAST_GAIN):
                out.append(None)
            else:
                out.append((int(used[f]), int(cut), side == 0, value, left[slot, f, cut, side], right[slot, f, cut, side]))
        return out

    def grow(self) -> None:
        """One round: a tree for each margin, level by level, all from the same passes."""
        s, names = self.settings, self.rows.features
        trees = [
            _Growing(k, _drawn_features(names, s.seed, len(self.rounds), k, s.colsample_bytree), [-2], [0], [True], [0], [0], [0.0], [0.0], [0.0])
            for k in range(self.rows.margins)
        ]
        per_pass = max(1, HISTOGRAM_NUMBERS // (len(trees[0].used) * self.rows.bins * 2))
        for depth in range(max(1, s.max_depth)):
            slots = [(t, n) for t, tree in enumerate(trees) for n, f in enumerate(tree.feature) if f == -2]
            for start in range(0, len(slots), per_pass):
                some = slots[start : start + per_pass]
                sums = self.histograms(trees, some)
                for t in sorted({t for t, _ in some}):
                    tree, own = trees[t], [i for i, (u, _) in enumerate(some) if u == t]
                    found = self.best(sums[own], tree.used) if s.max_depth else [None] * len(own)
                    for i, split in zip(own, found):
                        node = some[i][1]
                        if depth == 0:
                            tree.grad[node], tree.hess[node] = sums[i][0].sum(axis=0)
                        self._split(tree, node, split, depth + 1 < s.max_depth)
            if not slots:
                break
        self.rounds.append(trees)
        self.values.append([self._values(tree) for tree in trees])
        if len(self.rounds) - self.written >= self.checkpoint_rounds and len(self.rounds) < s.n_estimators:
            self.write_margins()

    @staticmethod
    def _split(tree: _Growing, node: int, split: tuple | None, goes_on: bool) -> None:
        tree.feature[node] = -1
        if split is None:
            return
        feature, at, missing_left, gain, left, right = split
        tree.feature[node], tree.at[node], tree.missing_left[node], tree.gain[node] = feature, at, missing_left, gain
        tree.left[node], tree.right[node] = len(tree.feature), len(tree.feature) + 1
        for grad, hess in (left, right):
            tree.feature.append(-2 if goes_on else -1)
            tree.at.append(0)
            tree.missing_left.append(True)
            tree.left.append(0)
            tree.right.append(0)
            tree.grad.append(float(grad))
            tree.hess.append(float(hess))
            tree.gain.append(0.0)

    def _values(self, tree: _Growing) -> np.ndarray:
        """What each leaf adds to the margin."""
        grad, hess = np.array(tree.grad), np.array(tree.hess) + self.settings.reg_lambda
        value = -self.settings.learning_rate * np.divide(grad, hess, out=np.zeros_like(grad), where=hess > 0)
        return np.where(np.array(tree.feature) < 0, value, 0.0)

    def ensemble(self) -> Ensemble:
        out = []
        for trees, values in zip(self.rounds, self.values):
            for tree, value in zip(trees, values):
                feature = np.array(tree.feature, np.int32)
                cut = [
                    math.nan if f < 0 else self.rows.cuts[f][at] if at < len(self.rows.cuts[f]) else math.inf
                    for f, at in zip(tree.feature, tree.at)
                ]
                out.append(
                    Tree(
                        tree.class_at, feature, np.array(cut, float), np.array(tree.missing_left),
                        np.array(tree.left, np.int32), np.array(tree.right, np.int32), value, np.array(tree.gain),
                        np.array(tree.hess),
                    )
                )
        return Ensemble(self.rows.features, self.rows.n_classes, tuple(out))


def boost(rows: BinnedRows, settings: BoostSettings, checkpoint_rounds: int = CHECKPOINT_ROUNDS) -> Ensemble:
    """Fit boosted trees to binned rows.

    Two classes share one margin (logistic loss); more have one each (softmax), and every round
    grows one tree for each from the same passes. A split's gain is the sum of squared
    gradients over (hessians + ``reg_lambda``) of its sides less that of the node; it must be
    above ``gamma``, and each side must have hessians of ``min_child_weight``. Equal gains go to
    the first feature, the least cut and missing values on the left.
    """
    fit = _Fit(rows, settings, checkpoint_rounds)
    try:
        for _ in range(settings.n_estimators):
            fit.grow()
        return fit.ensemble()
    finally:
        if fit.path:
            drop_path(rows.blocks.sparkSession, fit.path)


def first_splits(rows: BinnedRows, settings: BoostSettings) -> list[dict]:
    """The best split of the root by each feature and margin, in the first round: what a tree chooses from."""
    fit = _Fit(rows, replace(settings, colsample_bytree=1.0), CHECKPOINT_ROUNDS)
    every = np.arange(len(rows.features))
    trees = [_Growing(k, every, [-2], [0], [True], [0], [0], [0.0], [0.0], [0.0]) for k in range(rows.margins)]
    out = []
    for k, sums in enumerate(fit.histograms(trees, [(k, 0) for k in range(rows.margins)])):
        for f, name in enumerate(rows.features):
            found = fit.best(sums[None, f : f + 1], every[f : f + 1])[0]
            if found:
                _, at, missing_left, gain, left, right = found
                cuts = rows.cuts[f]
                values = [-settings.learning_rate * float(g) / (float(h) + settings.reg_lambda) for g, h in (left, right)]
                out.append(
                    {
                        "class_at": k, "feature": name, "cut": float(cuts[at]) if at < len(cuts) else math.inf,
                        "missing_left": bool(missing_left), "gain": gain, "left_value": values[0], "right_value": values[1],
                    }
                )
    return out
