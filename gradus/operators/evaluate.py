"""Model evaluation: residuals, sweeps, ROC, class metrics, calibration, drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from gradus.functions import guarded_ratio, normalize_id, unnest_together
from gradus.operators.prep import CONSTANT_TERM
from gradus.operators.ranking import global_row_number, running_totals
from gradus.session import broadcast_if_small, with_row

# Thresholds 0.00, 0.01 … 1.00 of the sweep.
SWEEP_STEPS = 100


# ---------------------------------------------------------------- regression


def residual_report(
    df: DataFrame, key: str, actual: str, prediction: str, scale: int | None = None
) -> DataFrame:
    """Residual per row, and on every row one minus the variance ratio."""
    residual = F.col(actual) - F.col(prediction)
    spread = df.agg((F.stddev_samp(residual)).alias("_r"), F.stddev_samp(actual).alias("_a"))
    ratio = F.when(F.col("_a") != 0, 1 - F.pow("_r", F.lit(2.0)) / F.pow("_a", F.lit(2.0)))
    one_row = spread.select(ratio.alias("r_square"))
    out = with_row(df.select(key, actual, prediction, residual.alias("residual")), one_row)
    if scale is None:
        return out
    return out.withColumns({c: F.round(c, scale) for c in (actual, prediction, "residual", "r_square")})


def model_rows(model: DataFrame) -> DataFrame:
    """One row (feature, coefficient, p_value) per feature of a model row."""
    return unnest_together(
        model, [], selected_feature=F.col("names"), coefficient=F.col("coef"), p_value=F.col("p_values")
    )


def top_coefficients(
    model: DataFrame, k: int = 20, positive: bool = True, level: float | None = 0.05
) -> DataFrame:
    """Strongest coefficients of one sign, rounded to two places.

    The sign is that of the unrounded value; the order is that of the rounded
    one, then the feature name. ``level=None`` skips the significance test.
    """
    rows = model_rows(model).where(F.col("selected_feature") != CONSTANT_TERM)
    if level is not None:
        rows = rows.where(F.col("p_value") < level)
    signed = rows.where(F.col("coefficient") > 0 if positive else F.col("coefficient") < 0)
    shown = signed.select(
        "selected_feature",
        F.round("coefficient", 2).alias("coefficient"),
        F.round("p_value", 2).alias("p_value"),
    )
    if level is None:
        shown = shown.drop("p_value")
    first = F.col("coefficient").desc() if positive else F.col("coefficient").asc()
    return shown.orderBy(first, "selected_feature").limit(k)


def relative_rank(model: DataFrame, sample: int = 1, level: float = 0.05) -> DataFrame:
    """Cumulative distribution of the absolute coefficients of significant features.

    One row per feature, so the ordered window is over a small frame.
    """
    rows = model_rows(model).where(
        (F.col("selected_feature") != CONSTANT_TERM) & (F.col("p_value") < level)
    )
    return rows.select(
        "selected_feature",
        "p_value",
        F.col("coefficient").alias("coef"),
        F.lit(sample).alias("sample"),
        F.cume_dist().over(Window.orderBy(F.abs("coefficient"))).alias("relative_rank"),
    )


def feature_importance(ranks: DataFrame) -> DataFrame:
    """Mean relative rank of each feature over the samples."""
    return (
        ranks.groupBy("selected_feature")
        .agg(F.avg("relative_rank").alias("feature_importance"))
        .orderBy(F.col("feature_importance").desc(), "selected_feature")
    )


def p_value_cdf(model: DataFrame) -> DataFrame:
    """For each distinct p-value the share of values counted so far.

    Distinct values are counted but divided by the number of all values, so the
    last share is below one when values are tied.
    """
    values = model.select(F.explode("p_values").alias("p_value"), F.size("p_values").alias("_n"))
    counts = values.groupBy("p_value").agg(F.max("_n").alias("_n"))
    running = F.count("*").over(Window.orderBy("p_value"))
    return counts.select("p_value", (running / F.col("_n")).alias("cdf"))


# ------------------------------------------------------------ threshold sweep


def _threshold(i: Column) -> Column:
    return i.cast("double") / F.lit(float(SWEEP_STEPS))


def threshold_sweep(df: DataFrame, prob: str, keep: Sequence[str]) -> DataFrame:
    """Every row at every threshold with its predicted class.

    The output is by definition 101 rows per input row; it is expanded inside
    the tasks, without a join. Use ``eval_metrics`` when only metrics are needed.
    """
    steps = F.explode(F.sequence(F.lit(0), F.lit(SWEEP_STEPS)))
    swept = df.select(*keep, prob, steps.alias("_i")).withColumn("threshold", _threshold(F.col("_i")))
    above = F.when(F.col(prob) > F.col("threshold"), 1).otherwise(0)
    return swept.drop("_i").withColumn("pred_class", above)


def thresholds_below(prob: Column) -> Column:
    """How many thresholds lie strictly below a probability.

    The product only gives a guess; the neighbours are compared as doubles, so
    the count agrees with comparing every threshold in turn.
    """
    top = SWEEP_STEPS + 1
    guess = F.least(F.greatest(F.ceil(prob * SWEEP_STEPS), F.lit(0)), F.lit(top)).cast("int")
    settled = (
        F.when((guess > 0) & (_threshold(guess - 1) >= prob), guess - 1)
        .when((guess < top) & (_threshold(guess) < prob), guess + 1)
        .otherwise(guess)
    )
    return F.when(prob.isNull(), 0).when(F.isnan(prob), top).otherwise(settled)


def eval_metrics(df: DataFrame, label: str, prob: str) -> DataFrame:
    """Precision, recall and F1 of both classes and the false-positive rate, per threshold.

    Rows are counted once into at most 102 buckets; the thresholds are then
    worked out from running counts over those buckets.
    """
    actual = F.col(label).cast("int")
    counted = df.groupBy(thresholds_below(F.col(prob).cast("double")).alias("bucket")).agg(
        F.count(F.when(actual == 1, 1)).alias("p"),
        F.count(F.when(actual == 0, 1)).alias("n"),
        F.count("*").alias("rows"),
    )
    buckets = df.sparkSession.range(SWEEP_STEPS + 2).select(F.col("id").cast("int").alias("bucket"))
    filled = buckets.join(F.broadcast(counted), "bucket", "left").na.fill(0)
    above = Window.orderBy("bucket").rowsBetween(1, Window.unboundedFollowing)
    everything = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cut = filled.select(
        "bucket",
        *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("p", "n", "rows")],
        *[F.sum(c).over(everything).alias(f"{c}_all") for c in ("p", "n", "rows")],
    ).where(F.col("bucket") <= SWEEP_STEPS)

    tp, fp = F.col("p_above"), F.col("n_above")
    tn = F.col("n_all") - fp
    rates = cut.where(F.col("rows_all") > 0).select(
        _threshold(F.col("bucket")).alias("threshold"),
        guarded_ratio(tp, F.col("rows_above")).alias("precision_p"),
        guarded_ratio(tp, F.col("p_all")).alias("recall_p"),
        guarded_ratio(tn, F.col("rows_all") - F.col("rows_above")).alias("precision_n"),
        guarded_ratio(tn, F.col("n_all")).alias("recall_n"),
        guarded_ratio(fp, F.col("n_all")).alias("fpr"),
    )

    def f1(side: str) -> Column:
        p, r = F.col(f"precision_{side}"), F.col(f"recall_{side}")
        return guarded_ratio(2.0 * p * r, p + r).alias(f"f1_score_{side}")

    return rates.select(
        "threshold", "precision_p", "recall_p", f1("p"), "precision_n", "recall_n", f1("n"), "fpr"
    ).orderBy("threshold")


def ensemble_probability(
    df: DataFrame, key: str, label: str, prob: str = "pred_prob", pos_class_weight: float = 1.0
) -> DataFrame:
    """Mean probability over the samples times the weight; may exceed one."""
    return df.groupBy(key, label).agg((F.avg(prob) * pos_class_weight).alias("avg_pred_prob"))


# ------------------------------------------------------------- class metrics


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows per pair of actual and predicted class; nulls are left out."""
    known = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    return known.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def class_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F and support per class; 0 where undefined.

    Everything follows from the confusion counts, whose size is the square of
    the number of classes.
    """
    counts = confusion_counts(df, actual, predicted)
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("actual").alias("class"),
                    F.col("n").alias("real"),
                    F.lit(0).cast("bigint").alias("said"),
                    F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("predicted").alias("class"),
                    F.lit(0).cast("bigint").alias("real"),
                    F.col("n").alias("said"),
                    F.lit(0).cast("bigint").alias("hit"),
                ),
            )
        )
    )
    total = sides.groupBy("class").agg(F.sum("real").alias("real"), F.sum("said").alias("said"), F.sum("hit").alias("hit"))

    def ratio(top: str, bottom: str) -> Column:
        return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))

    rated = total.select(
        "class",
        ratio("hit", "said").alias("precision"),
        ratio("hit", "real").alias("recall"),
        F.col("real").alias("support"),
    )
    both = F.col("precision") + F.col("recall")
    f = F.when(both > 0, 2.0 * F.col("precision") * F.col("recall") / both).otherwise(F.lit(0.0))
    return rated.select("class", "precision", "recall", f.alias("fscore"), "support").orderBy("class")


def confusion_matrix(
    df: DataFrame, actual: str, predicted: str, classes: Sequence | None = None
) -> DataFrame:
    """One row per actual class, one column per predicted class.

    Where there are too many classes for columns, ``confusion_counts`` has the same counts as rows.
    """
    counts = confusion_counts(df, actual, predicted)
    if classes is None:
        both = counts.select(F.explode(F.array("actual", "predicted")).alias("c")).distinct()
        classes = sorted(r["c"] for r in both.where("c IS NOT NULL").collect())
    cells = [
        F.coalesce(F.sum(F.when(F.col("predicted") == c, F.col("n"))), F.lit(0)).alias(f"predicted_{c}")
        for c in classes
    ]
    return counts.groupBy("actual").agg(*cells).orderBy("actual")


# ----------------------------------------------------------------------- ROC


def _scored_counts(df: DataFrame, label: str, prob: str, positive) -> DataFrame:
    """Positives and negatives per distinct score."""
    scored = df.where(F.col(label).isNotNull() & F.col(prob).isNotNull())
    hit = F.col(label) == positive
    return scored.groupBy(F.col(prob).alias("threshold")).agg(
        F.count(F.when(hit, 1)).alias("_pos"), F.count(F.when(~hit, 1)).alias("_neg")
    )


def _class_counts(df: DataFrame, label: str, probs: str, classes: Sequence) -> DataFrame:
    """Positives and negatives per class and distinct score, from one scan.

    Every row is read once for each class, and the copies combine per score
    before they are shuffled.
    """
    each = F.array(*[F.struct(F.lit(c).alias("class"), F.col(probs)[i].alias("threshold")) for i, c in enumerate(classes)])
    scored = df.where(F.col(label).isNotNull()).select(label, F.inline(each)).where(F.col("threshold").isNotNull())
    hit = F.col(label) == F.col("class")
    return scored.groupBy("class", "threshold").agg(
        F.count(F.when(hit, 1)).alias("_pos"), F.count(F.when(~hit, 1)).alias("_neg")
    )


def _curve(counts: DataFrame, within: Sequence[str]) -> DataFrame:
    swept = running_totals(
        counts, {"_tp": F.col("_pos"), "_fp": F.col("_neg")}, [F.col("threshold").desc()], within
    )
    totals = swept.groupBy(*within).agg(F.max("_tp").alias("_p"), F.max("_fp").alias("_n"))
    joined = swept.join(F.broadcast(totals), list(within)) if within else with_row(swept, totals)
    return joined.select(
        *within,
        "threshold",
        F.when(F.col("_n") > 0, F.col("_fp") / F.col("_n")).alias("fpr"),
        F.when(F.col("_p") > 0, F.col("_tp") / F.col("_p")).alias("tpr"),
    )


def roc_curve(df: DataFrame, label: str, prob: str, positive=1) -> DataFrame:
    """False- and true-positive rate at every distinct score, highest first.

    Rows are aggregated to distinct scores before the running counts are made.
    """
    return _curve(_scored_counts(df, label, prob, positive), [])


def roc_curve_per_class(df: DataFrame, label: str, probs: str, classes: Sequence) -> DataFrame:
    """The curve of every class against the rest, from an array of class probabilities."""
    return _curve(_class_counts(df, label, probs, classes), ["class"])


def _area(counts: DataFrame, within: Sequence[str], digits: int) -> DataFrame:
    swept = running_totals(counts, {"_upto": F.col("_neg")}, [F.col("threshold").asc()], within)
    wins = F.sum(F.col("_pos") * (F.col("_upto") - F.col("_neg") / 2.0))
    p, n = F.sum("_pos"), F.sum("_neg")
    area = F.when((p > 0) & (n > 0), F.round(wins / (p.cast("double") * n.cast("double")), digits))
    return swept.groupBy(*within).agg(area.alias("roc_auc"))


def roc_auc(df: DataFrame, label: str, prob: str, positive=1, digits: int = 5) -> DataFrame:
    """Area under the ROC curve of one class against the rest.

    A positive counts the negatives below its score and half of those at it.
    Null when either class is missing.
    """
    return _area(_scored_counts(df, label, prob, positive), [], digits)


def roc_auc_per_class(df: DataFrame, label: str, probs: str, classes: Sequence, digits: int = 5) -> DataFrame:
    """One row (class, roc_auc) per class from an array of class probabilities."""
    return _area(_class_counts(df, label, probs, classes), ["class"], digits)


def roc_sample(curve: DataFrame, points: int = 1000, digits: int = 5, within: Sequence[str] = ()) -> DataFrame:
    """Evenly spaced points of a curve: the threshold closest to each percentile.

    Percentiles 0, 100/points, … are interpolated between two neighbours of the
    ordered thresholds, so only two ranks per percentile are looked up. ``within``
    names columns that tell curves apart, such as the class; each is sampled.
    """
    if points < 1:
        raise ValueError("points must be at least 1")
    within = list(within)
    ranked = running_totals(curve, {"_rank": F.lit(1).cast("bigint")}, [F.col("threshold").asc()], within)
    sizes = ranked.groupBy(*within).agg(F.max("_rank").alias("_size")).where(F.col("_size").isNotNull())
    wanted = (
        sizes.select(*within, "_size", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
        .withColumn("_at", F.col("point") / F.lit(float(points)) * (F.col("_size") - 1))
        .select(*within, "point", "_at", F.explode(F.array(F.floor("_at"), F.ceil("_at"))).alias("_zero"))
        .distinct()
        .withColumn("_rank", F.col("_zero") + 1)
    )
    found = ranked.join(broadcast_if_small(wanted), [*within, "_rank"])
    low = F.min(F.struct("_zero", "threshold"))["threshold"]
    high = F.max(F.struct("_zero", "threshold"))["threshold"]
    near = found.groupBy(*within, "point", "_at").agg(
        low.alias("_low"),
        high.alias("_high"),
        F.min(F.struct("_zero", "fpr", "tpr")).alias("_first"),
        F.max(F.struct("_zero", "fpr", "tpr")).alias("_second"),
    )
    value = F.col("_low") + (F.col("_at") - F.floor("_at")) * (F.col("_high") - F.col("_low"))
    upper = (F.col("_high") - value) < (value - F.col("_low"))
    chosen = near.select(
        *within,
        "point",
        F.when(upper, F.col("_second")).otherwise(F.col("_first")).alias("_s"),
        F.when(upper, F.col("_high")).otherwise(F.col("_low")).alias("_t"),
    )
    return chosen.select(
        *within,
        "point",
        F.round("_s.fpr", digits).alias("fpr"),
        F.round("_s.tpr", digits).alias("tpr"),
        F.round("_t", digits).alias("threshold"),
    ).orderBy(*within, "point")


# ------------------------------------------------- grids, bands, bins, drift


def rank_grid_results(results: DataFrame, class_position: int, metric: str = "recall") -> DataFrame:
    """Grid rows by one metric of one class, best first."""
    picked = [F.element_at(c, class_position).alias(f"pos_{c}") for c in ("precision", "recall", "fscore")]
    rows = results.select("params_indx", "params", *picked)
    return rows.orderBy(F.col(f"pos_{metric}").desc_nulls_first(), "params_indx")


def unnest_importance(results: DataFrame) -> DataFrame:
    """One row per feature of each grid row."""
    return unnest_together(
        results, ["params_indx"], fnames=F.col("fnames"), f_importances=F.col("f_importances")
    )


def extreme_precision(
    scored: DataFrame,
    actuals: DataFrame,
    id_col: str,
    label: str,
    class_number: int,
    low: float,
    high: float,
    predicted: str | None = None,
    probs: str | None = None,
) -> DataFrame:
    """Mean correctness in the bands of low, middle and high probability.

    A missing probability falls in the middle band. With more than two classes
    a row's correctness can be negative.
    """
    said = F.col(predicted or f"{label}_predicted").cast("int")
    prob = F.element_at(F.col(probs or f"{label}_proba_predicted"), class_number + 1)
    known = actuals.select(F.col(id_col).alias("_id"), F.col(label).alias("_label"))
    joined = scored.join(known, scored[id_col] == known["_id"], "left")
    band = F.when(prob < low, "low").when(prob > high, "high").otherwise("mid")
    correct = 1 - F.abs(F.col("_label").cast("int") - said)
    return joined.groupBy(band.alias("pred_type")).agg(F.avg(correct).alias("prec"))


def calibration_bins(
    df: DataFrame, id_col: str, label: str, prob: str, bins: int = 20, normalise_ids: bool = False
) -> DataFrame:
    """Equal-count probability bins with mean probability and mean label on each row."""
    rows = df.select(
        (normalize_id(F.col(id_col)) if normalise_ids else F.col(id_col)).alias(id_col), prob, label
    )
    ranked = global_row_number(rows, [F.col(prob).asc_nulls_last(), F.col(id_col).asc_nulls_last()], "_rank")
    size = ranked.agg(F.count("*").alias("_n"))
    per, extra = F.floor(F.col("_n") / bins), F.col("_n") % bins
    zero = F.col("_rank") - 1
    long_rows = extra * (per + 1)
    binned = with_row(ranked, size).withColumn(
        "bin",
        F.when(zero < long_rows, F.floor(zero / (per + 1)) + 1)
        .otherwise(extra + F.floor((zero - long_rows) / F.greatest(per, F.lit(1))) + 1)
        .cast("int"),
    )
    means = binned.groupBy("bin").agg(
        F.avg(prob).alias("avg_pred_prob"), F.avg(F.col(label).cast("double")).alias(f"avg_{label}")
    )
    return binned.drop("_rank", "_n").join(F.broadcast(means), "bin").select(
        id_col, prob, label, "bin", "avg_pred_prob", f"avg_{label}"
    )


def column_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, nulls, mean, deviation, least and greatest value per column, in one scan."""
    if not cols:
        schema = "col_name string, count long, nulls long, mean double, stddev double, min double, max double"
        return df.sparkSession.createDataFrame([], schema)
    value = {c: F.col(c).cast("double") for c in cols}
    measures = {
        "count": lambda v: F.count(v),
        "nulls": lambda v: F.count(F.when(v.isNull(), 1)),
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    wide = df.agg(*[fn(value[c]).alias(f"{m}_{i}") for i, c in enumerate(cols) for m, fn in measures.items()])
    rows = [
        F.struct(F.lit(c).alias("col_name"), *[F.col(f"{m}_{i}").alias(m) for m in measures])
        for i, c in enumerate(cols)
    ]
    return wide.select(F.inline(F.array(*rows)))


def dataset_compare(a: DataFrame, b: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Per-column summary of two tables side by side and the difference of the means.

    Compares the columns that are numbers or flags in both tables, flags as 0 and 1; others
    are left out. Without such a column the result is empty.
    """
    usable, left_out = (NumericType, BooleanType), set(exclude)
    known = {f.name for f in b.schema if isinstance(f.dataType, usable)}
    shared = [f.name for f in a.schema if isinstance(f.dataType, usable) and f.name in known and f.name not in left_out]
    names = ["count", "nulls", "mean", "stddev", "min", "max"]
    left = column_summary(a, shared).select("col_name", *[F.col(n).alias(f"{n}_a") for n in names])
    right = column_summary(b, shared).select("col_name", *[F.col(n).alias(f"{n}_b") for n in names])
    return left.join(F.broadcast(right), "col_name").withColumn("mean_diff", F.col("mean_b") - F.col("mean_a"))


def drift_by_importance(comparison: DataFrame, importances: DataFrame) -> DataFrame:
    """Compared columns that have an importance, most important first."""
    joined = comparison.join(
        importances.select("fnames", "f_importances"),
        comparison["col_name"] == F.col("fnames"),
        "left",
    )
    return joined.where(F.col("f_importances").isNotNull()).drop("fnames").orderBy(
        F.col("f_importances").desc(), "col_name"
    )

