"""Linear models: least squares, elastic net, prediction and significance."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.functions import balanced_sum
from gradus.operators.gram import Gram, gram_matrix
from gradus.operators.prep import CONSTANT_TERM

MODEL_SCHEMA = (
    "names array<string>, coef array<double>, p_values array<double>, intercept double, r2 double"
)


@dataclass(frozen=True)
class LinearModel:
    """Coefficients in name order; a constant term is one of the features.

    ``settled`` tells that steps led to the only best point, so that a related fit can start there.
    """

    names: tuple[str, ...]
    coef: tuple[float, ...]
    p_values: tuple[float | None, ...] = ()
    intercept: float = 0.0
    r2: float | None = None
    settled: bool = field(default=False, compare=False)

    def to_df(self, spark: SparkSession) -> DataFrame:
        row = (list(self.names), list(self.coef), list(self.p_values), self.intercept, self.r2)
        return spark.createDataFrame([row], MODEL_SCHEMA)

    def significant(self, level: float = 0.05) -> tuple[str, ...]:
        """Features whose p-value is below the level; an unknown one is not."""
        pairs = zip(self.names, self.p_values)
        return tuple(n for n, p in pairs if p is not None and not math.isnan(p) and p < level)

    def score(self, values: Mapping[str, Column]) -> Column:
        """Intercept plus the sum of coefficient times value."""
        terms = [F.lit(self.intercept)]
        for name, coef in zip(self.names, self.coef):
            terms.append(F.lit(coef) if name == CONSTANT_TERM else F.lit(coef) * values[name])
        return balanced_sum(terms)

    def probability(self, values: Mapping[str, Column]) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.score(values)))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def student_two_sided(t: float, freedom: float) -> float:
    """Two-sided tail probability of Student's t."""
    if not math.isfinite(t):
        return 0.0 if math.isinf(t) else math.nan
    x = freedom / (freedom + t * t)
    a, b = freedom / 2.0, 0.5
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def linreg_from_gram(gram: Gram, features: Sequence[str], label: str, constant: bool = True) -> LinearModel:
    """Least squares from cross products; a pseudo-inverse covers collinear features."""
    plain = [f for f in features if f != CONSTANT_TERM]
    at, y = gram.index(plain), gram.index([label])[0]
    sxx, sxy, syy = gram.cross[np.ix_(at, at)], gram.cross[at, y], gram.cross[y, y]
    center, n = gram.mean[at], gram.n
    if not constant:
        sxx = sxx + n * np.outer(center, center)
        sxy = sxy + n * center * gram.mean[y]
    inverse = np.linalg.pinv(sxx, hermitian=True) if plain else np.zeros((0, 0))
    slope = inverse @ sxy
    total = syy if constant else syy + n * gram.mean[y] ** 2
    left = max(total - float(slope @ sxy), 0.0)
    freedom = n - len(plain) - (1 if constant else 0)
    variance = left / freedom if freedom > 0 else math.nan

    def p_value(coef: float, spread: float) -> float | None:
        if not (freedom > 0 and spread > 0):
            return None
        return student_two_sided(coef / math.sqrt(spread), freedom)

    fitted = {
        f: (float(b), p_value(float(b), variance * inverse[i, i]))
        for i, (f, b) in enumerate(zip(plain, slope))
    }
    if constant:
        level = float(gram.mean[y] - slope @ center)
        spread = variance * (1.0 / n + float(center @ inverse @ center))
        fitted[CONSTANT_TERM] = (level, p_value(level, spread))
    names = tuple(sorted(fitted))
    r2 = float(1.0 - left / syy) if syy > 0 else None
    return LinearModel(
        names, tuple(fitted[f][0] for f in names), tuple(fitted[f][1] for f in names), 0.0, r2
    )


def linreg_train(df: DataFrame, features: Sequence[str], label: str, constant: bool = True) -> LinearModel:
    """Least squares in one distributed pass over features and label."""
    plain = [f for f in features if f != CONSTANT_TERM]
    return linreg_from_gram(gram_matrix(df, [*plain, label]), plain, label, constant)


def elastic_net_train(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    alpha: float = 0.05,
    lambda_value: float = 0.05,
    max_iter: int = 10000,
    tol: float = 1e-6,
) -> LinearModel:
    """Gaussian elastic net with penalty λ(α·|b| + (1−α)/2·b²) on unscaled columns.

    One pass gathers the centred cross products, then coordinates are updated in turn
    until none moves by more than ``tol`` of the label's deviation: one solver and one
    objective at every width. Rows with a missing feature or label are left out.
    """
    plain = sorted(f for f in features if f != CONSTANT_TERM)
    gram = gram_matrix(df.select(*plain, F.col(label).cast("double").alias("_y")), [*plain, "_y"])
    if not gram.n or not gram.cross[-1, -1] > 0:
        raise ValueError("elastic net needs a label that varies")
    product, target = gram.cross[:-1, :-1] / gram.n, gram.cross[:-1, -1] / gram.n
    coef, pull = np.zeros(len(plain)), target.copy()
    scale = np.sqrt(gram.cross[-1, -1] / gram.n)
    diagonal = np.diag(product)
    for _ in range(max_iter):
        moved = 0.0
        for j in range(len(plain)):
            if diagonal[j] <= 0:
                continue
            free = pull[j] + diagonal[j] * coef[j]
            new = np.sign(free) * max(abs(free) - lambda_value * alpha, 0.0)
            new /= diagonal[j] + lambda_value * (1.0 - alpha)
            step = new - coef[j]
            if step:
                pull -= product[:, j] * step
                coef[j] = new
                moved = max(moved, abs(step) * np.sqrt(diagonal[j]))
        if moved <= tol * scale:
            break
    level = float(gram.mean[-1] - gram.mean[:-1] @ coef)
    return LinearModel(tuple(plain), tuple(float(c) for c in coef), (), level)


def predict(df: DataFrame, model: LinearModel, keep: Sequence[str], name: str = "prediction") -> DataFrame:
    """Add a linear prediction from columns named like the features."""
    return df.select(*keep, model.score({f: F.col(f) for f in model.names if f != CONSTANT_TERM}).alias(name))


def predict_probability(
    df: DataFrame, model: LinearModel, keep: Sequence[str], name: str = "pred_prob"
) -> DataFrame:
    """Add the logistic probability from columns named like the features."""
    values = {f: F.col(f) for f in model.names if f != CONSTANT_TERM}
    return df.select(*keep, model.probability(values).alias(name))


def significance_mask(model: DataFrame, level: float = 0.05) -> DataFrame:
    """One row with the 0/1 mask of a model row's p-values."""
    mask = F.transform("p_values", lambda p: F.when(p < level, 1).otherwise(0))
    return model.select(mask.alias("mask_arr"))
