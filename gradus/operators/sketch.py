"""Mergeable sketch of weighted quantiles of many columns at once.

Each row draws a uniform number from a hash of itself; its priority is that number over
its weight. A sketch keeps the rows of the smallest priorities, so merging sketches is
keeping the smallest of both, in any order and with the same result. A kept row stands for
the greater of its weight and the inverse of the first priority left out; the weight so
estimated of any set of rows has a standard error of at most the total weight over the
root of (size - 1), so ranks do as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a sketch, and numbers it holds at most.
ROWS = 1 << 15
NUMBERS = 1 << 24


@dataclass(frozen=True)
class QuantileSketch:
    """The kept rows (values by column), their weights and priorities, and the first priority left out."""

    size: int
    values: np.ndarray
    weights: np.ndarray
    priorities: np.ndarray
    threshold: float = np.inf

    @classmethod
    def of(cls, size: int, values: np.ndarray, weights: np.ndarray, uniform: np.ndarray) -> QuantileSketch:
        """The sketch of rows, whose uniform numbers lie above 0. Rows without weight count for nothing."""
        some = weights > 0
        return cls(size, values[some], weights[some], uniform[some] / weights[some])._cut()

    def _cut(self) -> QuantileSketch:
        """Rows above the threshold, or beyond the size, are left out."""
        if len(self.weights) <= self.size:
            inside = self.priorities < self.threshold
            if inside.all():
                return self
            return QuantileSketch(
                self.size, self.values[inside], self.weights[inside], self.priorities[inside], self.threshold
            )
        limit = min(self.threshold, float(np.partition(self.priorities, self.size)[self.size]))
        inside = self.priorities < limit
        return QuantileSketch(self.size, self.values[inside], self.weights[inside], self.priorities[inside], limit)

    def merge(self, other: QuantileSketch) -> QuantileSketch:
        """The sketch of the rows of both."""
        return QuantileSketch(
            min(self.size, other.size),
            np.concatenate([self.values, other.values]),
            np.concatenate([self.weights, other.weights]),
            np.concatenate([self.priorities, other.priorities]),
            min(self.threshold, other.threshold),
        )._cut()

    def standard_error(self) -> float:
        """Bound of the standard error of a rank, as a share of the whole weight; 0 if every row is kept."""
        return 0.0 if np.isinf(self.threshold) else 1.0 / np.sqrt(max(1, self.size - 1))

    def estimated(self) -> np.ndarray:
        """The weight that each kept row stands for."""
        return np.maximum(self.weights, 0.0 if np.isinf(self.threshold) else 1.0 / self.threshold)

    def rank(self, column: int, value: float) -> float:
        """Estimated share of the weight of values below the given one, missing ones left out."""
        own = self.values[:, column]
        known, weight = ~np.isnan(own), self.estimated()
        whole = weight[known].sum()
        return float(weight[known & (own < value)].sum() / whole) if whole else 0.0

    def cuts(self, column: int, parts: int) -> np.ndarray:
        """Ascending cuts (below it, from it on) into at most ``parts`` parts of about equal weight.

        With no more different values than parts, every value but the least is a cut.
        """
        own = self.values[:, column]
        known = ~np.isnan(own)
        values, place = np.unique(own[known], return_inverse=True)
        if len(values) <= parts:
            return values[1:]
        below = np.concatenate([[0.0], np.cumsum(np.bincount(place, weights=self.estimated()[known]))])
        wanted = below[-1] * np.arange(1, parts) / parts
        # The value whose weight below comes nearest to each wanted share.
        at = np.clip(np.searchsorted(below, wanted), 1, len(values) - 1)
        at = np.where(wanted - below[at - 1] < below[at] - wanted, at - 1, at)
        return values[np.unique(at[at > 0])]


def sketch_columns(
    df: DataFrame, cols: Sequence[Column], key: Column, weight: Column, n: int, total: float, rows: int = ROWS
) -> QuantileSketch:
    """Sketch of numeric columns over all rows of a frame; null and not-a-number values are missing.

    ``key`` is a 64-bit hash of the row, ``n`` the number of rows with a weight and ``total`` that weight.
    Rows far above the priority that can be kept are passed over where they are read, so about
    twice the size of the sketch moves, whatever the table's size. The result does not depend
    on partitions.
    """
    size = max(1, min(rows, NUMBERS // max(1, len(cols))))
    uniform = (F.shiftrightunsigned(key, 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    threshold = 2.0 * size / total if n > size else float("inf")
    drawn = df.select(
        F.array(*[F.coalesce(c.cast("double"), F.lit(float("nan"))) for c in cols]).alias("x"),
        weight.cast("double").alias("w"),
        uniform.alias("u"),
    ).where((F.col("w") > 0) & (F.col("u") / F.col("w") < threshold))
    found = drawn.toArrow()
    values = found.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    weights, numbers = found.column("w").to_numpy(), found.column("u").to_numpy()
    # Every row with a priority below the threshold is here.
    return QuantileSketch(size, values.reshape(len(weights), len(cols)), weights, numbers / weights, threshold)._cut()
