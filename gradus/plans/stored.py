"""Stored linear, elastic-net and logistic models: written by one session, scored in another."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.functions import balanced_sum
from gradus.operators.linear import LinearModel
from gradus.operators.prep import CONSTANT_TERM, FeatureStats, drop_duplicate_keys
from gradus.sources.tables import replace_table

REGRESSION, LOGISTIC = "regression", "logistic"

STORED_SCHEMA = (
    "kind string, sample int, intercept double, r2 double, feature string, "
    "coef double, p_value double, avg double, stddev double"
)


def read_back(spark: SparkSession, target: str) -> DataFrame:
    """What ``replace_table`` wrote: a folder when the name contains a slash, else a table."""
    return spark.read.parquet(target) if "/" in target else spark.table(target)


@dataclass(frozen=True)
class StoredModel:
    """Coefficients of one or more samples with the training statistics of their features."""

    kind: str
    models: tuple[LinearModel, ...]
    stats: FeatureStats

    @classmethod
    def of(cls, kind: str, models: list[LinearModel], stats: FeatureStats) -> "StoredModel":
        """Keeps the statistics of the features that the models use."""
        if not models:
            raise ValueError("the run has no model to store")
        used = {f for m in models for f in m.names}
        kept = [row for row in zip(stats.names, stats.avg, stats.stddev) if row[0] in used]
        return cls(kind, tuple(models), FeatureStats(*(tuple(r[i] for r in kept) for i in range(3))))

    def to_df(self, spark: SparkSession) -> DataFrame:
        """One row per sample and feature; a constant term has no statistics."""
        scale = {n: (a, s) for n, a, s in zip(self.stats.names, self.stats.avg, self.stats.stddev)}
        rows = []
        for sample, m in enumerate(self.models, start=1):
            p_values = m.p_values or (None,) * len(m.names)
            for name, coef, p in zip(m.names, m.coef, p_values):
                rows.append((self.kind, sample, m.intercept, m.r2, name, coef, p, *scale.get(name, (None, None))))
        return spark.createDataFrame(rows, STORED_SCHEMA)

    def save(self, spark: SparkSession, target: str) -> None:
        replace_table(self.to_df(spark), target)

    @classmethod
    def load(cls, spark: SparkSession, target: str) -> "StoredModel":
        """The model that ``save`` wrote. Its rows are bounded by samples times features."""
        rows = read_back(spark, target).orderBy("sample", "feature").collect()
        if not rows:
            raise ValueError(f"no model rows in {target}")
        models, scale = [], {}
        for sample in sorted({r["sample"] for r in rows}):
            own = [r for r in rows if r["sample"] == sample]
            models.append(
                LinearModel(
                    tuple(r["feature"] for r in own),
                    tuple(r["coef"] for r in own),
                    tuple(r["p_value"] for r in own),
                    own[0]["intercept"],
                    own[0]["r2"],
                )
            )
            scale |= {r["feature"]: (r["avg"], r["stddev"]) for r in own if r["feature"] != CONSTANT_TERM}
        names = tuple(sorted(scale))
        stats = FeatureStats(names, tuple(scale[n][0] for n in names), tuple(scale[n][1] for n in names))
        return cls(rows[0]["kind"], tuple(models), stats)

    def score(self, df: DataFrame, key: str) -> DataFrame:
        """Rows (key, prediction), or (key, pred_prob): the mean probability of the samples.

        New rows are normalised with the training statistics; missing values become
        the training mean and rows of duplicated keys are left out.
        """
        clean = drop_duplicate_keys(df.select(key, *self.stats.names), key)
        values = self.stats.normalised(clean)
        if self.kind == REGRESSION:
            return clean.select(key, self.models[0].score(values).alias("prediction"))
        mean = balanced_sum([m.probability(values) for m in self.models]) / F.lit(float(len(self.models)))
        return clean.select(key, mean.alias("pred_prob"))


def save_tables(run, prefix: str) -> list[str]:
    """Write every result frame of a run as ``<prefix>_<name>``; returns the names written."""
    written = []
    for name, value in vars(run).items():
        if isinstance(value, DataFrame):
            replace_table(value, f"{prefix}_{name}")
            written.append(f"{prefix}_{name}")
    return written
