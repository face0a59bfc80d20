import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from gradus.plans import build, runs, specs
from gradus.plans.stored import StoredModel, read_back, save_tables


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    out = []
    for i in range(4000):
        x, z, noise = rng.gauss(0, 1), rng.gauss(5, 2), rng.gauss(0, 1)
        y = 2 * x - z + noise
        c = int(x + 0.8 * noise > 0)
        out.append((f"k{i}", x, z if i % 9 else None, 3 * x + 1e-9 * noise, noise * 0, y, c if i % 11 else None))
    return spark.createDataFrame(out, "k string, x double, z double, copy double, flat double, y double, c int").persist()


def test_linear_run(spark, rows):
    run = runs.linear_run(rows, "k", "y", ["c"])
    assert run.status == "DONE"
    assert [r["discarded"] for r in run.vif(spark).collect()] == [True, False]
    assert "flat" not in run.prepared.stats.names and len(run.prepared.features) == 2
    assert run.residuals.first()["r_square"] > 0.7
    assert run.top_positive.count() == 1 and run.top_negative.first()["selected_feature"] == "z"
    scored = runs.regression_score(rows.select("k", "x", "z", "copy"), "k", run)
    held = run.residuals.select("k", F.col("prediction").alias("p")).join(scored, "k")
    assert held.where(F.abs(F.col("p") - F.col("prediction")) > 1e-9).count() == 0 and held.count() > 500
    run.release()


def test_runs_abort_without_a_significant_feature(spark):
    flat = spark.range(400).select(
        F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 20).cast("double").alias("x"),
        (F.floor(F.col("id") / 20) % 2).alias("c"), ((F.floor(F.col("id") / 20) % 2) - 0.5).alias("y"),
    )
    run = runs.logistic_run(flat, "k", "c", ["y"], folds=2)
    assert run.status == "ABORTED" and run.metrics is None


def test_logistic_run(spark, rows):
    run = runs.logistic_run(rows, "k", "c", ["y"], folds=3, pos_class_weight=1.5)
    assert run.status == "DONE" and len(run.samples) == 3
    assert run.metrics.count() == 101
    test_rows = run.probabilities.count()
    assert run.classes.count() == 101 * test_rows
    assert run.probabilities.agg(F.max("avg_pred_prob")).first()[0] > 1
    (top,) = {r["selected_feature"] for r in run.importance.collect()} & {"x", "copy"}
    assert run.top_positive.first()["selected_feature"] == top
    assert "constant_term" not in run.model.names
    assert runs.logistic_score(rows.drop("c"), "k", run).count() == rows.count()
    with pytest.raises(ValueError, match="folds"):
        runs.logistic_run(rows, "k", "c", folds=1)


def test_statistics_of_the_training_side_only(rows):
    every = runs.prepare(rows, "k", "y", ["c", "flat"], 5)
    train = runs.prepare(rows, "k", "y", ["c", "flat"], 5, fit_on="train")
    assert every.stats.avg != train.stats.avg


def test_elastic_net_run(rows):
    run = runs.elastic_net_run(rows, "k", "y", ["c"])
    assert run.status == "DONE" and run.residuals.first()["r_square"] > 0.7
    assert run.top_positive.columns == ["selected_feature", "coefficient"]


def test_build_model_end_to_end(spark, rows, tmp_path):
    base = rows.select(F.col("k").alias("pk1"), F.col("k").alias("person_uid"), F.col("c").alias("label"))
    tables = {
        "base": base,
        "f.scores": rows.select(F.col("k").alias("person_uid"), "x", "z", F.lit(1).alias("hs_zip")),
    }
    log = spark.createDataFrame([("f.scores", "CREATE", "TABLE", "2016-01-01")], "table_name string, action string, subtype string, ts string")
    log = log.withColumn("ts", F.col("ts").cast("timestamp"))
    calendar = spark.createDataFrame([("201610", date(2016, 1, 1), date(2016, 5, 1))], "academic_period string, start_date date, end_date date")
    spec = specs.InputSpec("made", "base", specs.TEMPLATE_RULES, daily=("f.scores",), sources={"sis": ("f.scores",)})
    result = build.build_model(
        spec, tables, log, calendar, date(2016, 7, 1), "pk1", "label", ["person_uid"],
        models=["", "LR", "XGBoost", "SVM"], sources=["sis"], output=str(tmp_path),
        logistic={"folds": 2}, boosted={"grid": {"max_depth": 2, "n_estimators": 2}},
    )
    assert result.table_name == "made_sis_01_Jul_2016"
    assert [r[0] for r in result.due.collect()] == ["f.scores"]
    assert result.rows.columns == ["pk1", "person_uid", "label", "x", "z"]
    assert result.runs["LR"].status == "DONE" and result.runs["XGBoost"].results.count() == 1
    assert result.notices == ["Unrecognized model name: SVM"]


def test_models_score_the_same_after_storing(spark, rows, tmp_path):
    run = runs.logistic_run(rows, "k", "c", ["y"], folds=2)
    want = {r["k"]: r["pred_prob"] for r in runs.logistic_score(rows, "k", run).collect()}
    run.stored().save(spark, f"{tmp_path}/logistic")
    written = save_tables(run, f"{tmp_path}/out")
    assert f"{tmp_path}/out_metrics" in written and read_back(spark, f"{tmp_path}/out_metrics").count() == 101
    run.release()
    again = StoredModel.load(spark, f"{tmp_path}/logistic")
    assert len(again.models) == 2 and again.kind == "logistic"
    assert {r["k"]: r["pred_prob"] for r in again.score(rows, "k").collect()} == want

    run = runs.linear_run(rows, "k", "y", ["c"])
    want = {r["k"]: r["prediction"] for r in runs.regression_score(rows, "k", run).collect()}
    run.stored().save(spark, f"{tmp_path}/linear")
    run.release()
    again = StoredModel.load(spark, f"{tmp_path}/linear")
    assert again.models[0].r2 == run.model.r2
    assert {r["k"]: r["prediction"] for r in again.score(rows, "k").collect()} == want
    with pytest.raises(ValueError, match="no model"):
        StoredModel.of("regression", [], run.prepared.stats)


def test_one_pass_from_held_rows_to_collinearity(rows, monkeypatch):
    from gradus.operators import gram, logistic

    passes, add = [], gram.sum_of_parts
    monkeypatch.setattr(gram, "sum_of_parts", lambda *a, **b: passes.append(1) or add(*a, **b))
    prepared = runs.prepare(rows, "k", "y", ["c"], None)
    assert len(passes) == 1 and prepared.steps
    prepared.release()
    steps, sums = [], logistic._newton_sums
    monkeypatch.setattr(logistic, "_newton_sums", lambda *a: steps.append(len(a[-1])) or sums(*a))
    runs.logistic_run(rows, "k", "c", ["y"], folds=4).release()
    # Passes are the steps of the longest fit, of the samples, of their refits and of the last fit.
    assert len(steps) < 3 * 12 and max(steps) == 4
