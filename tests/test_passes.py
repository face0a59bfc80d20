"""How often the rows of a table are read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradus.operators import assemble, logistic


def _counted(df):
    """The rows, and a counter of how many were made."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


def test_assembly_counts_its_base_once(spark):
    base, seen = _counted(spark.range(500).select(F.col("id").alias("pk1"), (F.col("id") % 50).alias("person_uid")))
    persons = spark.range(50).select(F.col("id").alias("person_uid"), (F.col("id") * 2).alias("f"))
    found = assemble.assemble_features(base, {"persons": persons}, assemble.FeatureRules(exclude=("person_uid",)))
    assert seen.value == 500
    assert found.where("f = 2 * person_uid").count() == 500


def test_rows_of_logistic_fits_are_made_once_for_all_passes(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1000, 2))
    y = (x @ [1.0, -0.5] + rng.logistic(size=1000) > 0).astype(int)
    rows = [(float(a), float(b), int(c), bool(k % 2)) for k, ((a, b), c) in enumerate(zip(x, y))]
    rows[3] = (None, *rows[3][1:])
    df, seen = _counted(spark.createDataFrame(rows, "b double, a double, y int, s boolean").repartition(3))
    fits = [logistic.LogisticFit(("a", "b"), "s"), logistic.LogisticFit(("b",), None)]
    whole = logistic.logreg_train_many(df, fits, "y")
    assert seen.value == 1000
    # Neither the size of the blocks nor the order of the packed features changes a fit.
    monkeypatch.setattr(logistic, "BLOCK", 7)
    packed = logistic.pack_rows(df, ["b", "a"], "y", ["s"])
    for got, want in zip(logistic.logreg_fit_packed(packed, fits), whole):
        assert got.names == want.names
        assert got.coef == pytest.approx(want.coef, rel=1e-9) and got.p_values == pytest.approx(want.p_values, rel=1e-7)
    packed.release()


def test_a_run_refits_from_its_first_fits(spark, monkeypatch):
    from gradus.plans import runs

    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 3))
    y = (x @ [1.5, -1.0, 0.0] + rng.logistic(size=4000) > 0.5).astype(int)
    rows = [(k, *map(float, v), int(c)) for k, (v, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, y int").repartition(4)
    passes, taken, sums, fits = [], [], logistic._newton_sums, runs.logreg_fit_packed

    def fit(packed, asked):
        found, near = fits(packed, asked), len(passes)
        plain = fits(packed, [logistic.LogisticFit(f.features, f.flag, f.constant) for f in asked])
        taken.append((near, len(passes) - near))
        passes.clear()
        for got, want in zip(found, plain):
            assert got.names == want.names and got.coef == pytest.approx(want.coef, rel=1e-9, abs=1e-12)
            assert got.p_values == pytest.approx(want.p_values, rel=1e-7, abs=1e-12)
        return found

    monkeypatch.setattr(runs, "logreg_fit_packed", fit)
    monkeypatch.setattr(logistic, "_newton_sums", lambda *a: passes.append(1) or sums(*a))
    run = runs.logistic_run(df, "id", "y", folds=2)
    assert run.status == runs.DONE and run.model.settled
    assert len(taken) == 3 and taken[0][0] == taken[0][1] and all(near < plain for near, plain in taken[1:])
    alone = logistic.logreg_train(df, ["a"], "y")
    assert alone.settled
    # One of two equal columns leaves no single best point to start from.
    assert not logistic.logreg_train(df.withColumn("d", F.col("a")), ["a", "d"], "y").settled
    run.release()


def test_shorter_keys_use_the_order_of_longer_ones(spark, monkeypatch):
    base = spark.range(600).select(
        F.col("id").alias("pk1"), (F.col("id") % 200).alias("person_uid"), (F.col("id") % 3).alias("academic_period")
    )
    terms = base.select("person_uid", "academic_period", F.col("pk1").alias("g"))
    persons = spark.range(0, 200, 2).select(F.col("id").alias("person_uid"), (F.col("id") * 3).alias("f"))
    rules = assemble.FeatureRules(exclude=("person_uid", "academic_period"))
    monkeypatch.setattr(assemble, "TASK_BYTES", 1 << 14)
    monkeypatch.setattr(assemble, "BROADCAST_ROW_LIMIT", 50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = assemble.assemble_features(base, {"p": persons, "t": terms}, rules)
        text = found._jdf.queryExecution().executedPlan().toString()
        rows = found.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Both tables are sorted, the base once for the two joins.
    assert text.count("SortMergeJoin") == 2 and text.count("Sort [") == 3
    assert found.columns == ["pk1", "person_uid", "academic_period", "f", "g"] and len(rows) == 600
    assert all(r["g"] == r["pk1"] and r["f"] == (None if r["person_uid"] % 2 else 3 * r["person_uid"]) for r in rows)
