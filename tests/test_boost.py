import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradus.operators import boost, ensemble, sketch


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    out = []
    for i in range(4000):
        x, z, t = rng.random(), rng.gauss(0, 1), rng.choice([None, 1.0, 2.0, 3.0])
        y = int(x + 0.3 * z + (0.5 if t is None else 0.0) + 0.1 * rng.random() > 0.7)
        out.append((i, x, None if i % 11 == 0 else z, t, y, min(2, int(3 * x)), 0.2 + rng.random()))
    return spark.createDataFrame(out, "id int, x double, z double, t double, y int, band int, w double").repartition(5).persist()


FEATURES = ["t", "x", "z"]


def plain_boost(x, y, w, settings):
    """Boosting by looking at every cut of every value, one row after the other (binary, all rows and features)."""
    margin, out = np.zeros(len(y)), []

    def grow(inside, g, h, depth):
        here = g[inside].sum() ** 2 / (h[inside].sum() + settings.reg_lambda)
        best = None
        for f in range(x.shape[1]):
            known = np.unique(x[inside & ~np.isnan(x[:, f]), f])
            for cut in [*np.unique(x[~np.isnan(x[:, f]), f])[1:], np.inf] if len(known) else []:
                for side in (True, False):
                    left = inside & np.where(np.isnan(x[:, f]), side, x[:, f] < cut)
                    right = inside & ~left
                    low, high = h[left].sum(), h[right].sum()
                    if min(low, high) < settings.min_child_weight or min(low, high) <= 0:
                        continue
                    gain = g[left].sum() ** 2 / (low + settings.reg_lambda) + g[right].sum() ** 2 / (high + settings.reg_lambda) - here
                    if best is None or gain > best[0] + 1e-7:
                        best = (gain, f, cut, side, left, right)
        if depth == settings.max_depth or best is None or best[0] <= max(settings.gamma, 1e-6):
            margin[inside] += -settings.learning_rate * g[inside].sum() / (h[inside].sum() + settings.reg_lambda)
            return
        out.append(best[:4])
        grow(best[4], g, h, depth + 1)
        grow(best[5], g, h, depth + 1)

    for _ in range(settings.n_estimators):
        p = 1 / (1 + np.exp(-margin))
        grow(np.ones(len(y), bool), (p - y) * w, p * (1 - p) * w, 0)
    return margin, out


def test_against_plain_boosting(spark):
    rng = random.Random(1)
    data = [(i, rng.randrange(8) * 1.0, rng.choice([None, 0.5, 1.5, 2.5]), rng.randrange(2), 0.5 + rng.random()) for i in range(300)]
    data = [(i, a, b, int(a > 3 or b is None) if i % 5 else y, w) for i, a, b, y, w in data]
    df = spark.createDataFrame(data, "id int, a double, b double, y int, w double").repartition(4)
    settings = boost.BoostSettings(learning_rate=0.3, max_depth=3, n_estimators=3, min_child_weight=2, gamma=0.05)
    binned = boost.bin_rows(df, "id", ["a", "b"], F.col("y"), F.col("w"), 2)
    model = boost.boost(binned, settings)
    x = np.array([(a, np.nan if b is None else b) for _, a, b, _, _ in data])
    margin, splits = plain_boost(x, np.array([d[3] for d in data]), np.array([d[4] for d in data]), settings)
    got = {r["id"]: r["_probs"][1] for r in ensemble.score(df, model, [F.col("id")]).collect()}
    assert np.allclose([got[k] for k in range(300)], 1 / (1 + np.exp(-margin)), atol=1e-6)
    found = sorted((t.gain[n], model.features[t.feature[n]], t.cut[n]) for t in model.trees for n in range(len(t.feature)) if t.feature[n] >= 0)
    want = sorted((g, "ab"[f], cut) for g, f, cut, _ in splits)
    assert [s[1:] for s in found] == [s[1:] for s in want] and np.allclose([s[0] for s in found], [s[0] for s in want], rtol=1e-5)


def same(a, b):
    return len(a.trees) == len(b.trees) and all(
        np.array_equal(getattr(s, f), getattr(t, f), equal_nan=f in ("cut", "value", "gain", "cover"))
        for s, t in zip(a.trees, b.trees)
        for f in ensemble.TREE_FIELDS
    )


def test_partitions_do_not_change_a_tree(rows):
    settings = boost.BoostSettings(n_estimators=4, max_depth=4, subsample=0.7, colsample_bytree=0.7)
    fits = []
    for parts in (1, 3, 17):
        binned = boost.bin_rows(rows.repartition(parts, "x"), "id", FEATURES, F.col("y"), F.col("w"), 2, bins=20, sketch_rows=500)
        fits.append(boost.boost(binned, settings))
        binned.release()
    assert same(fits[0], fits[1]) and same(fits[0], fits[2])


def test_written_margins_and_small_passes_do_not_change_a_tree(spark, rows, monkeypatch):
    settings = boost.BoostSettings(n_estimators=5, max_depth=3)
    binned = boost.bin_rows(rows, "id", FEATURES, F.col("band"), F.col("w"), 3, bins=16)
    whole = boost.boost(binned, settings)
    assert len(whole.trees) == 15 and {t.class_at for t in whole.trees} == {0, 1, 2}
    assert same(whole, boost.boost(binned, settings, checkpoint_rounds=2))
    monkeypatch.setattr(boost, "HISTOGRAM_NUMBERS", 200)
    assert same(whole, boost.boost(binned, settings))
    found = ensemble.score(rows, whole, [F.col("band")])
    assert found.where("_at = band").count() > 0.95 * found.count()  # of 16 parts none ends at a third


def test_missing_values_choose_a_side(spark):
    """Missing values behave like large ones here, then like small ones."""
    for high in (True, False):
        data = [(i, None if i % 4 == 0 else float(i % 9), int(i % 4 == 0 if high else i % 4 != 0 and i % 9 > 4)) for i in range(900)]
        df = spark.createDataFrame([(i, x, int(y or (high and x is not None and x > 4))) for i, x, y in data], "id int, x double, y int")
        binned = boost.bin_rows(df, "id", ["x"], F.col("y"), F.lit(1.0), 2)
        tree = boost.boost(binned, boost.BoostSettings(n_estimators=1, max_depth=1)).trees[0]
        assert tree.cut[0] == 5.0 and bool(tree.missing_left[0]) is not high


def test_parameters():
    assert boost.BoostSettings.of({"max_depth": "4", "gamma": 1}, 3) == boost.BoostSettings(max_depth=4, gamma=1.0, seed=3)
    with pytest.raises(ValueError, match="unknown tree parameters"):
        boost.BoostSettings.of({"seed": 1}, 3)


def test_columns_are_drawn_for_a_tree():
    names = [f"f{k}" for k in range(20)]
    drawn = [tuple(boost._drawn_features(names, 1, r, 0, 0.5)) for r in range(30)]
    assert all(len(d) == 10 for d in drawn) and len(set(drawn)) > 25
    assert len({f for d in drawn for f in d}) == 20
    keys = np.arange(100_000, dtype=np.int64)
    shares = [boost._drawn(keys, 1, r, 0.3).mean() for r in range(5)]
    assert all(abs(s - 0.3) < 0.01 for s in shares)


def test_node_tables_come_back(spark, rows, tmp_path):
    binned = boost.bin_rows(rows, "id", FEATURES, F.col("y"), F.col("w"), 2)
    model = boost.boost(binned, boost.BoostSettings(n_estimators=6, max_depth=4))
    model.save(spark, str(tmp_path / "nodes"))
    again = ensemble.Ensemble.load(spark, str(tmp_path / "nodes"), FEATURES, 2)
    want = sorted(map(tuple, ensemble.score(rows, model, [F.col("id")]).select("id", "_at", F.col("_probs")[1]).collect()))
    for found in (ensemble.score(rows, again, [F.col("id")]), ensemble.score(rows, again, [F.col("id")], part_nodes=40)):
        assert sorted(map(tuple, found.select("id", "_at", F.col("_probs")[1]).collect())) == want
    assert again.splits() == model.splits() and again.gains() == pytest.approx(model.gains())
    listed = {r["feature"]: r["splits"] for r in ensemble.node_table_splits(model.rows(spark)).collect()}
    assert listed == model.splits()


def test_an_ensemble_without_trees(spark, rows):
    found = ensemble.score(rows.limit(3), ensemble.Ensemble(("x",), 3, ()), [F.col("id")]).collect()
    assert [r["_at"] for r in found] == [0, 0, 0] and found[0]["_probs"] == pytest.approx([1 / 3] * 3)


def test_sketch_after_a_hundred_merges():
    pick = np.random.default_rng(5)
    n, size = 200_000, 4000
    values = np.column_stack([pick.normal(size=n), pick.integers(0, 7, n).astype(float), np.where(pick.random(n) < 0.3, np.nan, pick.exponential(size=n))])
    weights = pick.exponential(size=n) * np.where(pick.random(n) < 0.05, 20, 1)
    uniform = (pick.permutation(n) + 0.5) / n
    parts = [sketch.QuantileSketch.of(size, values[k::101], weights[k::101], uniform[k::101]) for k in range(101)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.merge(part)
    turned = parts[-1]
    for part in parts[-2::-1]:
        turned = part.merge(turned)
    whole = sketch.QuantileSketch.of(size, values, weights, uniform)
    for other in (turned, whole):
        assert sorted(merged.priorities) == sorted(other.priorities) and merged.threshold == other.threshold
    error = merged.standard_error()
    assert error == pytest.approx(1 / np.sqrt(size - 1))
    for column in range(3):
        known = ~np.isnan(values[:, column])
        total = weights[known].sum()
        for at in np.quantile(values[known, column], np.linspace(0.01, 0.99, 30)):
            true = weights[known & (values[:, column] < at)].sum() / total
            assert abs(merged.rank(column, at) - true) < 4 * error
        cuts = merged.cuts(column, 16)
        assert np.all(np.diff(cuts) > 0) and np.array_equal(cuts, whole.cuts(column, 16))
    assert merged.cuts(1, 16).tolist() == [1, 2, 3, 4, 5, 6]
    shares = np.diff([0, *(weights[values[:, 0] < c].sum() / weights.sum() for c in merged.cuts(0, 16)), 1])
    assert np.all(np.abs(shares - 1 / 16) < 8 * error)


def test_sketch_of_a_frame(spark):
    df = spark.range(50_000).select("id", (F.col("id") % 1000).cast("double").alias("x"), F.lit(2.0).alias("w"))
    key = F.xxhash64("id")
    found = [sketch.sketch_columns(df.repartition(k), [F.col("x")], key, F.col("w"), 50_000, 100_000.0, rows=2000) for k in (2, 9)]
    assert sorted(found[0].priorities) == sorted(found[1].priorities) and len(found[0].weights) == 2000
    assert abs(found[0].rank(0, 500.0) - 0.5) < 0.05 and found[0].estimated().sum() == pytest.approx(100_000, rel=0.1)
    exact = sketch.sketch_columns(df.limit(100), [F.col("x")], key, F.col("w"), 100, 200.0, rows=2000)
    assert exact.standard_error() == 0 and exact.rank(0, 50.0) == pytest.approx(0.5) and exact.cuts(0, 1000).size == 99


def test_partitions_of_blocks_stay_small(spark, monkeypatch):
    """One partition of many blocks is dealt out, so that no task gets them all as one batch; the trees are the same."""
    monkeypatch.setattr(boost, "BLOCK", 64)
    df = spark.range(4000).selectExpr("id", "(id * 37 % 101) / 7D as a", "cast(id % 13 as double) as b", "cast(id * 37 % 101 > 50 as int) as y")
    settings = boost.BoostSettings(n_estimators=3, max_depth=2)
    one = boost.bin_rows(df.coalesce(1), "id", ["a", "b"], F.col("y"), F.lit(1.0), 2)
    whole = boost.boost(one, settings, checkpoint_rounds=2).rows(spark).collect()
    monkeypatch.setattr(boost, "TASK_BYTES", 8000)
    many = boost.bin_rows(df.coalesce(1), "id", ["a", "b"], F.col("y"), F.lit(1.0), 2)
    sizes = [r[0] for r in many.blocks.groupBy(F.spark_partition_id()).agg(F.sum("n")).select("sum(n)").collect()]
    assert sum(sizes) == 4000 and many.tasks >= 16 and max(sizes) <= 4000 / 8
    assert boost.boost(many, settings, checkpoint_rounds=2).rows(spark).collect() == whole
    one.release()
    many.release()
