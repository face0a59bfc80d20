"""Variance inflation factors and the stepwise removal of collinear features."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from gradus.operators.gram import Gram, gram_matrix
from gradus.operators.prep import CONSTANT_TERM

# Reported where a feature is an exact combination of the others. Fixed value.
EXACT_COLLINEARITY = 1e100

# A determination within this of one counts as exact.
EXACT_TOLERANCE = 1e-10

# Least share in the null space that makes a feature part of a combination.
NULL_SHARE = 1e-8

# Factors this close count as equal, and the first feature in order is taken.
TIE = 1e-9

# The inverse is worked out anew after a feature with a larger factor left it, as digits are lost there.
LOSSY = 1e6

STEP_SCHEMA = "step int, feature_w_max_vif string, vif double, discarded boolean"


def _factors(corr: np.ndarray, names: Sequence[str]) -> dict[str, float]:
    """Factors 1 / (1 - R²) in feature order; features that do not vary are skipped.

    The factor is the feature's entry on the diagonal of the inverse. Where the
    matrix is singular, a feature with a share in its null space is an exact
    combination of others; for the rest the pseudo-inverse serves.
    """
    vary = [i for i in range(len(names)) if np.isfinite(corr[i, i])]
    if not vary:
        return {}
    values, vectors = np.linalg.eigh(corr[np.ix_(vary, vary)])
    null = values <= EXACT_TOLERANCE * max(values[-1], 1.0)
    shares = (vectors[:, null] ** 2).sum(axis=1)
    diagonal = (vectors[:, ~null] ** 2 / values[~null]).sum(axis=1)
    return {
        names[i]: EXACT_COLLINEARITY if share > NULL_SHARE else max(float(factor), 1.0)
        for i, share, factor in zip(vary, shares, diagonal)
    }


def vif_scores(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows (feature, vif) from one correlation pass."""
    features = [f for f in features if f != CONSTANT_TERM]
    scores = _factors(gram_matrix(df, features).correlation(features), features)
    return df.sparkSession.createDataFrame(list(scores.items()), "feature string, vif double")


def vif_steps(
    gram: Gram, features: Sequence[str], threshold: float = 10.0, steps: int | None = None
) -> list[tuple[int, str, float, bool]]:
    """Steps of the removal, all worked out on one correlation matrix.

    Only singular or nearly singular matrices are decomposed anew in each step;
    elsewhere the inverse is downdated. Each step records the feature with the largest factor. It is removed unless
    its factor is below the threshold, and marked discarded only above it.
    """
    left = [f for f in features if f != CONSTANT_TERM]
    corr = gram.correlation(left)
    at = {name: i for i, name in enumerate(left)}
    found: list[tuple[int, str, float, bool]] = []
    limit = len(left) if steps is None else steps
    scores = _factors(corr, left)
    inverse: np.ndarray | None = None
    while scores and len(found) < limit:
        largest = max(scores.values())
        worst = next(name for name, score in scores.items() if score >= largest * (1 - TIE))
        found.append((len(found), worst, scores[worst], scores[worst] > threshold))
        if scores[worst] < threshold:
            break
        kept = [i for i, name in enumerate(scores) if name != worst]
        names, worst_at = [name for name in scores if name != worst], list(scores).index(worst)
        if largest > LOSSY or not names:
            inverse = None
        elif inverse is None:
            rows = [at[name] for name in scores]
            inverse = np.linalg.inv(corr[np.ix_(rows, rows)])
        if inverse is None:
            rows = [at[name] for name in names]
            scores = _factors(corr[np.ix_(rows, rows)], names)
            continue
        # Without one feature the inverse changes by a matrix of rank one.
        column = inverse[kept, worst_at]
        inverse = inverse[np.ix_(kept, kept)] - np.outer(column, column) / inverse[worst_at, worst_at]
        scores = {name: max(float(factor), 1.0) for name, factor in zip(names, np.diag(inverse))}
    return found


def steps_to_df(spark: SparkSession, steps: list) -> DataFrame:
    return spark.createDataFrame(steps, STEP_SCHEMA)


def vif_select(
    df: DataFrame, features: Sequence[str], threshold: float = 10.0, steps: int | None = None
) -> DataFrame:
    """Rows (step, feature_w_max_vif, vif, discarded)."""
    features = [f for f in features if f != CONSTANT_TERM]
    found = vif_steps(gram_matrix(df, features), features, threshold, steps)
    return steps_to_df(df.sparkSession, found)


def vif_select_wide(
    df: DataFrame, id_col: str, exclude: Sequence[str] = (), threshold: float = 10.0, steps: int | None = None
) -> DataFrame:
    """The same on all numeric columns of a wide table, in table order."""
    numeric = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    usable = [c for c, t in df.dtypes if t in numeric or t.startswith("decimal")]
    return vif_select(df, [c for c in usable if c != id_col and c not in set(exclude)], threshold, steps)


def vif_mask(names: Sequence[str], steps: Sequence[tuple[int, str, float, bool]]) -> list[int]:
    """0 where a step discarded the feature, else 1."""
    dropped = {feature for _, feature, _, discarded in steps if discarded}
    return [0 if name in dropped else 1 for name in names]


def importance_mask(names: Sequence[str], selected: Sequence[str]) -> list[int]:
    """1 where the feature is among the selected ones, else 0."""
    wanted = set(selected)
    return [1 if name in wanted else 0 for name in names]
