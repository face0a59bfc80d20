import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from gradus.operators import linear, logistic, vif
from gradus.operators.gram import Gram, gram_matrix
from gradus.operators.linear import LinearModel


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 4000
    x = rng.normal(size=(n, 3))
    x[:, 2] = 0.9 * x[:, 0] + 0.4 * x[:, 2] + 1000
    y = 2 + 3 * x[:, 0] - x[:, 1] + rng.normal(size=n)
    p = 1 / (1 + np.exp(-(0.5 + x[:, 0] - 0.7 * x[:, 1])))
    c = (rng.random(n) < p).astype(int)
    rows = [(int(i), *map(float, x[i]), float(y[i]), int(c[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, a double, b double, d double, y double, c int").repartition(5).persist()
    return df, x, y, c


def test_gram_matches_numpy_with_large_offsets(data):
    df, x, *_ = data
    gram = gram_matrix(df, ["a", "b", "d"])
    assert gram.n == len(x)
    np.testing.assert_allclose(gram.mean, x.mean(axis=0), rtol=1e-10, atol=1e-10)
    np.testing.assert_allclose(gram.cross / (gram.n - 1), np.cov(x.T), rtol=1e-9)


def test_least_squares_against_the_library(data):
    df, *_ = data
    model = linear.linreg_train(df, ["a", "b", "d"], "y")
    fitted = LinearRegression(featuresCol="x", labelCol="y", solver="normal").fit(
        VectorAssembler(inputCols=["a", "b", "d"], outputCol="x").transform(df)
    )
    coef = dict(zip(model.names, model.coef))
    np.testing.assert_allclose([coef[f] for f in "abd"], fitted.coefficients.toArray(), rtol=1e-8)
    assert math.isclose(coef["constant_term"], fitted.intercept, rel_tol=1e-6)
    p = dict(zip(model.names, model.p_values))
    want = dict(zip(["a", "b", "d", "constant_term"], fitted.summary.pValues))
    for name in want:
        assert math.isclose(p[name], want[name], rel_tol=1e-5, abs_tol=1e-12)
    assert math.isclose(model.r2, fitted.summary.r2, rel_tol=1e-9)


def test_least_squares_without_constant_and_with_collinear_columns(data):
    df, x, y, _ = data
    model = linear.linreg_train(df, ["a", "b"], "y", constant=False)
    want = np.linalg.lstsq(x[:, :2], y, rcond=None)[0]
    np.testing.assert_allclose(model.coef, want, rtol=1e-9)
    twice = linear.linreg_train(df.withColumn("a2", F.col("a") * 2), ["a", "a2", "b"], "y")
    coef = dict(zip(twice.names, twice.coef))
    alone = dict(zip(*(lambda m: (m.names, m.coef))(linear.linreg_train(df, ["a", "b"], "y"))))
    assert math.isclose(coef["a"] + 2 * coef["a2"], alone["a"], rel_tol=1e-8)


def test_student_tail_known_values():
    assert math.isclose(linear.student_two_sided(2.0, 10), 0.07338803, rel_tol=1e-6)
    assert math.isclose(linear.student_two_sided(12.706204736, 1), 0.05, rel_tol=1e-6)
    s = 0.5 / math.sqrt(3)
    three = 1 - 2 / math.pi * (math.atan(s) + s / (1 + s * s))
    assert math.isclose(linear.student_two_sided(0.5, 3), three, rel_tol=1e-12)
    assert linear.student_two_sided(0.0, 5) == 1.0


def _newton(x, y, steps=30):
    z = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-z @ b))
        h = (z * (p * (1 - p))[:, None]).T @ z
        b = b + np.linalg.solve(h, z.T @ (y - p))
    return b, np.sqrt(np.diag(np.linalg.inv(h)))


def test_logistic_against_newton(data):
    df, x, _, c = data
    model = logistic.logreg_train(df, ["a", "b"], "c")
    b, se = _newton(x[:, :2], c)
    coef, p = dict(zip(model.names, model.coef)), dict(zip(model.names, model.p_values))
    for i, name in enumerate(["constant_term", "a", "b"]):
        assert math.isclose(coef[name], b[i], rel_tol=1e-6)
        assert math.isclose(p[name], math.erfc(abs(b[i] / se[i]) / math.sqrt(2)), rel_tol=1e-3, abs_tol=1e-12)


def test_logistic_with_exactly_collinear_columns_reports_p_values(data):
    df, *_ = data
    model = logistic.logreg_train(df.withColumn("a2", F.col("a") * 2), ["a", "a2", "b"], "c")
    coef = dict(zip(model.names, model.coef))
    alone = logistic.logreg_train(df, ["a", "b"], "c")
    assert math.isclose(coef["a"] + 2 * coef["a2"], dict(zip(alone.names, alone.coef))["a"], rel_tol=1e-3)
    assert all(p is not None for p in model.p_values)


def test_logistic_keeps_digits_with_large_offsets_and_refuses_one_class(data):
    df, *_ = data
    plain = logistic.logreg_train(df, ["a", "b"], "c")
    moved = logistic.logreg_train(df.withColumn("a", F.col("a") + 1e5), ["a", "b"], "c")
    for i, name in enumerate(plain.names):
        if name != "constant_term":
            assert math.isclose(plain.coef[i], moved.coef[i], rel_tol=1e-6)
            assert math.isclose(plain.p_values[i], moved.p_values[i], rel_tol=1e-4, abs_tol=1e-30)
    with pytest.raises(ValueError, match="both classes"):
        logistic.logreg_train(df.withColumn("one", F.lit(1)), ["a"], "one")


def test_logistic_takes_many_columns(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 300))
    c = (rng.random(1500) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, c)], [*(f"x{i:03d}" for i in range(300)), "c"])
    model = logistic.logreg_train(df, [f"x{i:03d}" for i in range(300)], "c", constant=False)
    z = x @ np.array(model.coef)
    assert np.abs(x.T @ (c - 1 / (1 + np.exp(-z)))).max() < 1e-5
    assert len(model.p_values) == 300 and model.p_values[0] < 1e-6


def test_short_plan_folds_agree_with_the_driver_sum(data, monkeypatch):
    from gradus.operators import gram

    df, *_ = data
    want = gram_matrix(df, ["a", "b", "d"])
    monkeypatch.setattr(gram, "DRIVER_NUMBERS", 0)
    for parts in (12, 100):
        got = gram_matrix(df.repartition(parts), ["a", "b", "d"])
        np.testing.assert_allclose(got.cross, want.cross, rtol=1e-9)


def test_removal_steps_agree_with_a_fresh_inverse(data):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(500, 12)) @ rng.normal(size=(12, 12))
    names = [f"f{i:02d}" for i in range(12)]
    cross = (x - x.mean(0)).T @ (x - x.mean(0))
    steps = vif.vif_steps(Gram(tuple(names), 500.0, x.mean(0), cross), names, 3.0)
    assert len(steps) > 3
    left = list(names)
    for _, feature, factor, _ in steps:
        at = [names.index(f) for f in left]
        fresh = dict(zip(left, np.diag(np.linalg.inv(np.corrcoef(x[:, at].T)))))
        assert feature == max(fresh, key=fresh.get) and math.isclose(factor, fresh[feature], rel_tol=1e-8)
        left.remove(feature)


def test_logistic_of_the_constant_alone_and_of_one_class(data):
    df, *_, c = data
    model = logistic.logreg_train(df, [], "c")
    assert math.isclose(model.coef[0], math.log(c.mean() / (1 - c.mean())), rel_tol=1e-9)
    with pytest.raises(ValueError, match="both classes"):
        logistic.logreg_train(df.withColumn("one", F.lit(1)), [], "one")


def test_elastic_net_meets_the_optimality_conditions(data):
    df, x, y, _ = data
    alpha, lam = 0.4, 0.3
    model = linear.elastic_net_train(df, ["a", "b", "d"], "y", alpha, lam, tol=1e-12)
    b = np.array([dict(zip(model.names, model.coef))[f] for f in "abd"])
    residual = y - x @ b - model.intercept
    assert abs(residual.mean()) < 1e-6
    gradient = -(x - x.mean(axis=0)).T @ residual / len(y) + lam * (1 - alpha) * b
    for g, coef in zip(gradient, b):
        if coef == 0:
            assert abs(g) <= lam * alpha + 1e-5
        else:
            assert abs(g + lam * alpha * np.sign(coef)) < 1e-5


def test_vif_against_regressions(data):
    df, x, *_ = data
    found = {r["feature"]: r["vif"] for r in vif.vif_scores(df, ["a", "b", "d"]).collect()}
    for i, name in enumerate("abd"):
        z = np.column_stack([np.ones(len(x)), np.delete(x, i, axis=1)])
        left = x[:, i] - z @ np.linalg.lstsq(z, x[:, i], rcond=None)[0]
        assert math.isclose(found[name], x[:, i].var() / left.var(), rel_tol=1e-6)


def test_vif_of_exact_combinations_and_flat_columns(spark, data):
    df, *_ = data
    wide = df.withColumn("s", F.col("a") + F.col("b")).withColumn("flat", F.lit(1.0))
    found = {r["feature"]: r["vif"] for r in vif.vif_scores(wide, ["a", "b", "d", "s", "flat"]).collect()}
    assert found["a"] == found["b"] == found["s"] == 1e100 and "flat" not in found
    assert 1 < found["d"] < 20
    steps = [tuple(r) for r in vif.vif_select(wide, ["a", "b", "d", "s", "flat"]).collect()]
    assert steps[0][1:] == ("a", 1e100, True) and steps[-1][3] is False
    assert vif.vif_mask(["a", "b"], steps) == [0, 1]


def test_vif_at_the_threshold_is_removed_but_not_marked(data):
    df, *_ = data
    gram = gram_matrix(df, ["a", "b"])
    score = vif.vif_steps(gram, ["a", "b"], 10.0)[0][2]
    steps = vif.vif_steps(gram, ["a", "b"], score)
    assert steps[0][3] is False and len(steps) == 2
    assert vif.vif_steps(gram, ["a", "b"], score, steps=1) == steps[:1]
    assert vif.vif_steps(gram_matrix(df.withColumn("f", F.lit(2.0)), ["f"]), ["f"]) == []


def test_significance(spark):
    model = LinearModel(("a", "b", "c"), (1.0, 2.0, 3.0), (0.01, None, 0.05))
    assert model.significant() == ("a",)
    assert linear.significance_mask(model.to_df(spark)).first()[0] == [1, 0, 0]


def test_elastic_net_of_two_columns_meets_its_conditions(spark):
    """At the optimum the slope of the squared error balances the penalty, coordinate by coordinate."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    x[:, 1] += 0.7 * x[:, 0]
    y = 2 * x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=400) * 0.1 + 4
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    model = linear.elastic_net_train(df, ["a", "b", "c"], "y", alpha=0.6, lambda_value=0.3, tol=1e-12)
    coef = np.array(model.coef)
    rest = (x - x.mean(0)).T @ (y - y.mean() - (x - x.mean(0)) @ coef) / 400
    for slope, b in zip(rest, coef):
        if b:
            assert slope == pytest.approx(0.3 * (0.6 * np.sign(b) + 0.4 * b), abs=1e-8)
        else:
            assert abs(slope) <= 0.18 + 1e-9


def test_moments_of_columns_with_missing_values(spark):
    from gradus.operators import gram

    rng = np.random.default_rng(11)
    x = rng.normal(size=(2000, 5)) * [1, 1e-3, 50, 1, 1] + [1e6, 0, -3, 7, 0]
    x[:, 3] = 7.5  # does not vary
    x[:, 4] += x[:, 0] - 1e6
    lost = rng.random((2000, 5)) < [0, 0.2, 0.5, 0.1, 0.3]
    lost[:, 1] |= rng.random(2000) < 0.1
    rows = [tuple(None if m else float(v) for v, m in zip(*r)) for r in zip(x, lost)] + [(None,) * 5]
    names = list("abcde")
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(7)
    found = gram.masked_moments(df, [(n, F.col(n)) for n in names])
    held = np.where(lost, np.nan, x)
    assert found.n == 2001 and found.count.tolist() == (~lost).sum(0).tolist()
    assert np.allclose(found.mean, np.nanmean(held, 0), rtol=1e-12)
    assert np.allclose(found.deviation(), np.nanstd(held, 0, ddof=1), rtol=1e-9) and found.deviation()[3] == 0
    scaled = np.nan_to_num((held - np.nanmean(held, 0)) / np.nanstd(held, 0, ddof=1))[:, [0, 1, 2, 4]]
    assert np.allclose(found.scaled(["a", "b", "c", "e"]).cross, scaled.T @ scaled, rtol=1e-8, atol=1e-7)
    plain = gram.masked_moments(df, [(n, F.col(n)) for n in names], products=False)
    assert np.allclose(plain.mean, found.mean) and np.allclose(plain.squares, found.squares) and plain.products is None
    # A first value far off the others costs a second pass, not digits.
    far = spark.createDataFrame([(1e9,)] + [(float(k % 2) * 1e-3,) for k in range(3000)], "a double").coalesce(1)
    want = np.std([1e9] + [float(k % 2) * 1e-3 for k in range(3000)], ddof=1)
    assert gram.masked_moments(far, [("a", F.col("a"))]).deviation()[0] == pytest.approx(want, rel=1e-9)


def test_many_logistic_fits_share_their_passes(spark, monkeypatch):
    from gradus.operators import logistic

    rng = np.random.default_rng(12)
    x = rng.normal(size=(1500, 3))
    y = (x @ [1.0, -0.5, 0.0] + rng.logistic(size=1500) > 0.3).astype(int)
    rows = [(*map(float, v), int(c), bool(k % 3), bool(k % 4 == 0)) for k, (v, c) in enumerate(zip(x, y))]
    rows[5] = (None, *rows[5][1:])
    df = spark.createDataFrame(rows, "a double, b double, c double, y int, s boolean, t boolean").repartition(4).persist()
    fits = [
        logistic.LogisticFit(("a", "b", "c"), "s"), logistic.LogisticFit(("a", "c"), "t"), logistic.LogisticFit(("b",), None),
        logistic.LogisticFit(("a", "b"), "s", constant=False), logistic.LogisticFit(("constant_term",), "t"),
    ]
    passes, sums = [], logistic._newton_sums
    monkeypatch.setattr(logistic, "_newton_sums", lambda *a: passes.append(len(a[-1])) or sums(*a))
    together = logistic.logreg_train_many(df, fits, "y")
    shared = len(passes)
    alone = []
    for fit in fits:
        passes.clear()
        alone.append((logistic.logreg_train(df.where(fit.flag) if fit.flag else df, fit.features, "y", fit.constant), len(passes)))
    assert shared == max(n for _, n in alone)
    for got, (want, _) in zip(together, alone):
        assert got.names == want.names and got.coef == pytest.approx(want.coef, abs=1e-8)
        assert got.p_values == pytest.approx(want.p_values, abs=1e-8)
