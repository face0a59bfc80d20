"""Modelling runs: clean, normalise, select, split, fit, evaluate.

Each run keeps the normalised features as wide columns, because Spark prunes and
compiles plain columns, and holds on to two frames while it iterates: the
normalised rows and nothing else. What reaches the driver is statistics per
column, one cross-product matrix and coefficients.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.functions import balanced_sum, hash_uniform
from gradus.operators import evaluate
from gradus.operators.gram import masked_moments
from gradus.operators.linear import LinearModel, elastic_net_train, linreg_train
from gradus.operators.logistic import LogisticFit, LogisticRows, logreg_fit_packed, pack_rows
from gradus.operators.prep import (
    CONSTANT_TERM,
    FeatureStats,
    as_double,
    drop_duplicate_keys,
    feature_names,
    normalise_wide,
)
from gradus.operators.split import fold_draw
from gradus.operators.vif import steps_to_df, vif_mask, vif_steps
from gradus.plans.stored import LOGISTIC, REGRESSION, StoredModel
from gradus.session import hold

DONE, ABORTED = "DONE", "ABORTED"
VIF_THRESHOLD = 10.0

# Columns that hold the draws of the split and of the samples.
DRAW, FOLD = "_draw", "_fold_"


@dataclass
class Prepared:
    """Normalised rows, the held ones they come from, the statistics behind them and the collinearity steps."""

    rows: DataFrame
    held: DataFrame
    stats: FeatureStats
    steps: list
    features: list[str]
    label: str
    train_fraction: float

    def train_and_test(self) -> tuple[DataFrame, DataFrame]:
        """Both sides of the split, from the draw held with the rows."""
        known = self.rows.where(F.col(self.label).isNotNull())
        return known.where(F.col(DRAW) <= self.train_fraction), known.where(F.col(DRAW) > self.train_fraction)

    def with_samples(self, folds: int) -> tuple[DataFrame, list[str]]:
        """All rows, and the names of flags on the training rows that leave about one fold out of each sample."""
        flags = [f"_sample_{i}" for i in range(1, folds + 1)]
        trained = F.col(DRAW) <= self.train_fraction
        kept = {flag: trained & (F.col(f"{FOLD}{i}") != i - 1) for i, flag in enumerate(flags, start=1)}
        return self.rows.withColumns(kept), flags

    def release(self) -> None:
        self.held.unpersist()


def prepare(
    df: DataFrame,
    key: str,
    label: str,
    exclude: Iterable[str],
    vif_step_limit: int | None,
    fit_on: str = "all",
    train_fraction: float = 0.8,
    seed: int = 42,
    folds: int = 0,
) -> Prepared:
    """Drop duplicated keys, impute, normalise and remove collinear features.

    Statistics and collinearity use all rows, test rows included, unless
    ``fit_on='train'`` restricts them to the training side of the split. The
    draws of the split and of the samples are hashed once and held with the
    rows, because every pass of a fit filters on them. One pass over the held rows
    gives the statistics and, missing values accounted for, the cross products of the
    normalised columns; these are a projection of the held rows and never written.
    """
    cols = feature_names(df, [*exclude, key, label])
    if not cols:
        raise ValueError("no feature columns left after the exclusions")
    draws = {DRAW: hash_uniform(seed, F.col(key))}
    draws |= {f"{FOLD}{i}": fold_draw(key, folds, i, seed).cast("int") for i in range(1, folds + 1)}
    clean = hold(drop_duplicate_keys(df.select(key, label, *cols), key).withColumns(draws))
    basis = clean
    if fit_on != "all":
        basis = clean.where(F.col(label).isNotNull() & (F.col(DRAW) <= train_fraction))
    moments = masked_moments(basis, [(c, as_double(df, c)) for c in cols])
    stats = FeatureStats.of(moments)
    steps = vif_steps(moments.scaled(stats.names), stats.names, VIF_THRESHOLD, vif_step_limit)
    kept = [f for f, m in zip(stats.names, vif_mask(stats.names, steps)) if m]
    rows = normalise_wide(clean, stats, [key, label, *draws]).select(key, label, *kept, *draws)
    return Prepared(rows, clean, stats, steps, kept, label, train_fraction)


@dataclass
class RegressionRun:
    """Result of a linear or elastic-net run."""

    status: str
    prepared: Prepared
    model: LinearModel | None = None
    first_model: LinearModel | None = None
    residuals: DataFrame | None = None
    top_positive: DataFrame | None = None
    top_negative: DataFrame | None = None

    def stored(self) -> StoredModel:
        """The model with its training statistics, to save and to score with."""
        return StoredModel.of(REGRESSION, [self.model] if self.model else [], self.prepared.stats)

    def vif(self, spark: SparkSession) -> DataFrame:
        return steps_to_df(spark, self.prepared.steps)

    def release(self) -> None:
        self.prepared.release()


def _regression_report(run: RegressionRun, test: DataFrame, key: str, label: str, level: float | None) -> None:
    model = run.model
    predicted = test.select(
        key, label, model.score({f: F.col(f) for f in model.names if f != CONSTANT_TERM}).alias("prediction")
    )
    run.residuals = evaluate.residual_report(predicted, key, label, "prediction")
    row = model.to_df(test.sparkSession)
    if level is None:
        values = [None] * len(model.names)
        row = LinearModel(model.names, model.coef, tuple(values), model.intercept).to_df(test.sparkSession)
    run.top_positive = evaluate.top_coefficients(row, positive=True, level=level)
    run.top_negative = evaluate.top_coefficients(row, positive=False, level=level)


def linear_run(
    df: DataFrame,
    key: str,
    label: str,
    exclude: Iterable[str] = (),
    vif_step_limit: int | None = None,
    train_fraction: float = 0.8,
    seed: int = 42,
    fit_on: str = "all",
) -> RegressionRun:
    """Least squares, refitted on the significant features and tested on held-out rows."""
    prepared = prepare(df, key, label, exclude, vif_step_limit, fit_on, train_fraction, seed)
    train, test = prepared.train_and_test()
    first = linreg_train(train, prepared.features, label)
    chosen = first.significant()
    run = RegressionRun(DONE, prepared, first_model=first)
    if not chosen:
        run.status = ABORTED
        return run
    run.model = linreg_train(train, chosen, label, constant=CONSTANT_TERM in chosen)
    _regression_report(run, test, key, label, 0.05)
    return run


def elastic_net_run(
    df: DataFrame,
    key: str,
    label: str,
    exclude: Iterable[str] = (),
    vif_step_limit: int | None = None,
    train_fraction: float = 0.8,
    seed: int = 42,
    fit_on: str = "all",
    **trainer,
) -> RegressionRun:
    """The same with an elastic net, which needs no significance step.

    ``trainer`` takes alpha, lambda_value, max_iter and tol.
    """
    prepared = prepare(df, key, label, exclude, vif_step_limit, fit_on, train_fraction, seed)
    train, test = prepared.train_and_test()
    run = RegressionRun(DONE, prepared, model=elastic_net_train(train, prepared.features, label, **trainer))
    _regression_report(run, test, key, label, None)
    return run


def regression_score(df: DataFrame, key: str, run: RegressionRun) -> DataFrame:
    """Rows (key, prediction) for a new table, normalised with the training statistics."""
    return run.stored().score(df, key)


@dataclass
class LogisticRun:
    """Result of a logistic run; every frame is lazy."""

    status: str
    prepared: Prepared
    samples: list[LinearModel] = field(default_factory=list)
    model: LinearModel | None = None
    ranks: DataFrame | None = None
    importance: DataFrame | None = None
    probabilities: DataFrame | None = None
    classes: DataFrame | None = None
    metrics: DataFrame | None = None
    top_positive: DataFrame | None = None
    top_negative: DataFrame | None = None
    p_value_cdf: DataFrame | None = None

    def stored(self) -> StoredModel:
        """The samples' models with the training statistics, to save and to score with."""
        return StoredModel.of(LOGISTIC, self.samples, self.prepared.stats)

    def vif(self, spark: SparkSession) -> DataFrame:
        return steps_to_df(spark, self.prepared.steps)

    def release(self) -> None:
        self.prepared.release()


def logistic_run(
    df: DataFrame,
    key: str,
    label: str,
    exclude: Iterable[str] = (),
    vif_step_limit: int | None = None,
    train_fraction: float = 0.8,
    folds: int = 4,
    pos_class_weight: float = 1.0,
    seed: int = 42,
    fit_on: str = "all",
) -> LogisticRun:
    """Logistic ensemble over leave-fold samples, evaluated, then refitted on all rows.

    Rows are packed once for all fits. Samples are flags on them, and all are fitted in the same
    passes. A sample without a significant feature is skipped; without any the run is aborted.
    """
    if folds < 2:
        raise ValueError("folds must be at least 2")
    prepared = prepare(df, key, label, exclude, vif_step_limit, fit_on, train_fraction, seed, folds)
    test = prepared.train_and_test()[1]

    sampled, flags = prepared.with_samples(folds)
    packed = pack_rows(sampled, prepared.features, label, flags)
    try:
        return _logistic_fits(LogisticRun(ABORTED, prepared), packed, flags, test, key, label, pos_class_weight)
    finally:
        packed.release()


def _logistic_fits(
    run: LogisticRun, packed: LogisticRows, flags: list[str], test: DataFrame, key: str, label: str, pos_class_weight: float
) -> LogisticRun:
    """Fit the samples and all rows, and put what follows into the run."""
    spark, prepared = test.sparkSession, run.prepared
    first = logreg_fit_packed(packed, [LogisticFit(tuple(prepared.features), flag) for flag in flags])
    chosen = [(i, m.significant()) for i, m in enumerate(first, start=1) if m.significant()]
    # With all features the rows have one best point, so it is the same for any start, and so with some of them.
    near = all(m.settled for m in first)
    again = [
        LogisticFit(names, flags[i - 1], CONSTANT_TERM in names, dict(zip(first[i - 1].names, first[i - 1].coef)) if near else None)
        for i, names in chosen
    ]
    kept = [(i, m) for (i, _), m in zip(chosen, logreg_fit_packed(packed, again) if again else [])]
    run.samples = [m for _, m in kept]
    # A model whose significant features include only the constant ranks nothing.
    selected = sorted({f for _, m in kept for f in m.significant() if f != CONSTANT_TERM})
    if not selected:
        return run

    ranks = [evaluate.relative_rank(m.to_df(spark), i) for i, m in kept]
    run.ranks = ranks[0]
    for more in ranks[1:]:
        run.ranks = run.ranks.unionByName(more)
    run.importance = evaluate.feature_importance(run.ranks)

    # Keys are unique here, so the mean over samples is a row-wise expression.
    values = {f: F.col(f) for f in prepared.features}
    mean = balanced_sum([m.probability(values) for _, m in kept]) / F.lit(float(len(kept)))
    run.probabilities = test.select(key, label, (mean * pos_class_weight).alias("avg_pred_prob"))
    run.classes = evaluate.threshold_sweep(run.probabilities, "avg_pred_prob", [key, label])
    run.metrics = evaluate.eval_metrics(run.probabilities, label, "avg_pred_prob")

    start = None
    if near and all(m.settled for _, m in kept):
        found = [dict(zip(m.names, m.coef)) for _, m in kept]
        start = {f: sum(c.get(f, 0.0) for c in found) / len(found) for f in selected}
    run.model = logreg_fit_packed(packed, [LogisticFit(tuple(selected), constant=False, start=start)])[0]
    row = run.model.to_df(spark)
    run.top_positive = evaluate.top_coefficients(row, positive=True)
    run.top_negative = evaluate.top_coefficients(row, positive=False)
    run.p_value_cdf = evaluate.p_value_cdf(row)
    run.status = DONE
    return run


def logistic_score(df: DataFrame, key: str, run: LogisticRun) -> DataFrame:
    """Rows (key, pred_prob) for a new table: the ensemble's mean probability."""
    return run.stored().score(df, key)


__all__: Sequence[str] = [
    "ABORTED",
    "DONE",
    "LogisticRun",
    "Prepared",
    "RegressionRun",
    "elastic_net_run",
    "linear_run",
    "logistic_run",
    "logistic_score",
    "prepare",
    "regression_score",
]
