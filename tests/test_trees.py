import random

import pytest
from pyspark.sql import functions as F

from gradus.operators import evaluate, trees


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    out = []
    for i in range(3000):
        x, z = rng.random(), rng.random()
        missing = rng.random() < 0.3
        y = int(x + (0.8 if missing else 0.0) + 0.2 * rng.random() > 0.8)
        out.append((i, x, None if missing else z, y, ["low", "mid", "top"][min(2, int(x * 3))], int(i % 4 != 0)))
    schema = "id int, x double, z double, y int, band string, split int"
    return spark.createDataFrame(out, schema).repartition(4).persist()


def test_grid_is_the_product_in_key_order():
    grid = trees.expand_grid({"a": [1, 2], "b": 5, "c": ["p", "q"]})
    assert len(grid) == 4 and grid[1] == {"a": 1, "b": 5, "c": "q"}


def test_weights_given_or_by_rarity(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "y string")
    auto = {r["class"]: r["weight"] for r in trees.class_weights(df, "y").collect()}
    assert auto == pytest.approx({"a": 0.25, "b": 0.75})
    with pytest.raises(ValueError, match="no weight"):
        trees.class_weights(df, "y", {"a": 1.0})


def test_boosted_grid_finds_the_signal_and_uses_missing_values(spark, rows):
    run = trees.gbt_grid_search(rows, "id", "y", ["band", "split"], {"max_depth": [1, 3], "n_estimators": 4})
    found = run.results.orderBy("params_indx").collect()
    assert [r["params_indx"] for r in found] == [1, 2]
    assert found[0]["params"] == "max_depth=1, n_estimators=4"
    assert found[1]["features"] == ["x", "z"] and set(found[1]["fnames"]) == {"x", "z"}
    assert sum(found[1]["support"]) == run.test_ids.count()
    model = trees.load_model(run.results, F.col("params_indx") == 2)
    assert model.classes == (0, 1) and model.nullable == ("z",)
    scored = trees.tree_score(rows, "id", model, "y")
    assert evaluate.roc_auc(scored.withColumn("p", F.element_at("y_proba_predicted", 2)), "y", "p").first()[0] > 0.9
    metrics = trees.score_metrics(scored, "y", model.classes).collect()
    assert [r["class"] for r in metrics] == [0, 1] and metrics[0]["roc_auc"] == metrics[1]["roc_auc"]
    every = trees.tree_score_all(rows, "id", model, "y", points=10)
    listed = every.metrics.collect()
    assert set(listed[0]["fnames"]) == {"x", "z"} and listed[0]["f_importances"] == found[1]["f_importances"]
    assert sorted(every.curves.groupBy("class").count().collect()) == [(0, 10), (1, 10)] and every.rows.count() == rows.count()
    blind = trees.tree_score_all(rows.drop("y"), "id", model)
    assert blind.curves is None and blind.metrics.first()["recall"] == "NA" and blind.metrics.first()["fnames"]
    unlabelled = trees.tree_score(rows.drop("y"), "id", model)
    assert unlabelled.columns == ["id", "class_label_predicted", "class_label_proba_predicted"]
    assert trees.score_metrics(unlabelled, None, model.classes).first()["recall"] == "NA"
    run.release()


def test_many_classes_one_against_the_rest(spark, rows):
    run = trees.gbt_grid_search(rows, "id", "band", ["y", "split"], {"max_depth": 2, "n_estimators": 3})
    row = run.results.first()
    assert row["classes"] == ["low", "mid", "top"] and min(row["recall"]) > 0.8
    scored = trees.tree_score(rows, "id", trees.load_model(run.results, F.lit(True)))
    total = scored.select(F.expr("aggregate(class_label_proba_predicted, 0d, (a, b) -> a + b)").alias("s"))
    low, high = total.agg(F.min("s"), F.max("s")).first()
    assert low == pytest.approx(1) and high == pytest.approx(1)


def test_forest_refuses_depth_and_splits_by_column(spark, rows):
    with pytest.raises(ValueError, match="30 at most"):
        trees.rf_grid_search(rows, "id", "band", ["y"], {"max_depth": 32}, split_col="split")
    run = trees.rf_grid_search(
        rows, "id", "band", ["y"], {"max_depth": 30, "min_samples_split": 17, "n_estimators": 3}, split_col="split"
    )
    assert run.test_ids.count() == rows.where("split = 0").count()
    assert "split" not in run.results.first()["features"]
    assert trees.load_model(run.results, F.col("kind") == "rf").classes == ("low", "mid", "top")
    with pytest.raises(ValueError, match="no grid row"):
        trees.load_model(run.results, F.lit(False))


def test_one_class_is_refused(rows):
    with pytest.raises(ValueError, match="two classes"):
        trees.gbt_grid_search(rows.withColumn("y", F.lit(1)), "id", "y", ["band", "split"], {"n_estimators": 2})


def test_unknown_parameters_are_refused(rows):
    with pytest.raises(ValueError, match="unknown tree parameters"):
        trees.gbt_grid_search(rows, "id", "y", ["band", "split"], {"depth": 3})


def test_forest_of_many_classes_and_given_weights(spark):
    df = spark.range(3000).select("id", (F.col("id") % 150).alias("y"), (F.col("id") % 150 * 1.0).alias("x"))
    run = trees.rf_grid_search(df, "id", "y", [], {"max_depth": 4, "n_estimators": 2})
    assert len(run.results.first()["classes"]) == 150
    many = spark.range(2400).select((F.col("id") % 1200).alias("y"))
    given = trees.class_weights(many, "y", {k: k + 0.5 for k in range(1200)})
    assert {r["class"]: r["weight"] for r in given.collect()} == {k: k + 0.5 for k in range(1200)}
    with pytest.raises(ValueError, match="no weight given"):
        trees.class_weights(many, "y", {0: 1.0})


def test_fits_do_not_depend_on_partitions(spark, rows):
    grid = {"n_estimators": 3, "max_depth": 3, "subsample": 0.6}
    two = [
        trees.gbt_grid_search(rows.repartition(n), "id", "y", ["band", "split"], grid).results.first() for n in (2, 9)
    ]
    assert two[0]["gains"] == two[1]["gains"] and two[0]["f_importances"] == two[1]["f_importances"]


def test_a_stopped_grid_goes_on(spark, rows, tmp_path, monkeypatch):
    grid = {"max_depth": [1, 2, 3], "n_estimators": 2}
    whole = trees.gbt_grid_search(rows, "id", "y", ["band", "split"], grid).results.drop("mdl_train_ts", "model_path")
    fitted, boost = [], trees.boost

    def counted(binned, settings):
        if len(fitted) == 2:
            raise RuntimeError("stopped")
        fitted.append(settings.max_depth)
        return boost(binned, settings)

    monkeypatch.setattr(trees, "boost", counted)
    asked = dict(id_col="id", label="y", exclude=["band", "split"], grid=grid, parallelism=1, ledger=str(tmp_path))
    with pytest.raises(RuntimeError, match="stopped"):
        trees.gbt_grid_search(rows, **asked)
    assert fitted == [1, 2]
    fitted[:] = [0]
    run = trees.gbt_grid_search(rows, **asked)
    assert fitted == [0, 3]
    assert sorted(run.results.drop("mdl_train_ts", "model_path").collect(), key=str) == sorted(whole.collect(), key=str)
    assert run.model(2).fitted.n_classes == 2
    fitted[:] = []
    # Other rows, or other settings at the same place, are fitted anew.
    monkeypatch.setattr(trees, "boost", lambda binned, settings: fitted.append(settings.max_depth) or boost(binned, settings))
    trees.gbt_grid_search(rows, **{**asked, "grid": {"max_depth": [1, 5], "n_estimators": 2}})
    assert fitted == [5]
    trees.gbt_grid_search(rows.where("id > 5"), **{**asked, "grid": {"max_depth": 1, "n_estimators": 2}})
    assert fitted == [5, 1]
