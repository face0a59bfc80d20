import random

import pytest
from pyspark.sql import functions as F

from gradus.operators import evaluate
from gradus.operators.linear import LinearModel


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(9)
    rows = []
    for i in range(3000):
        prob = 0.35 if rng.random() < 0.4 else round(rng.random() * 1.1, 3)
        rows.append((i, prob, int(rng.random() < prob)))
    return spark.createDataFrame(rows, "id int, p double, y int").repartition(6).persist(), rows


def test_buckets_agree_with_every_threshold(spark):
    values = [i / 100 for i in range(101)] + [i / 1000 + 1e-17 for i in range(-5, 1010)]
    values += [i * 0.01 for i in range(101)] + [1.7, -0.2]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "p double")
    found = df.select("p", evaluate.thresholds_below(F.col("p")).alias("n")).collect()
    for r in found:
        want = 0 if r["p"] is None else sum(i / 100 < r["p"] for i in range(101))
        assert r["n"] == want, r


def test_eval_metrics_against_brute_force(scored):
    df, rows = scored
    got = evaluate.eval_metrics(df, "y", "p").collect()
    assert len(got) == 101
    for r in got:
        t = r["threshold"]
        tp = sum(p > t and y == 1 for _, p, y in rows)
        fp = sum(p > t and y == 0 for _, p, y in rows)
        pos, neg = sum(y for *_, y in rows), sum(1 - y for *_, y in rows)
        assert r["recall_p"] == pytest.approx(tp / pos)
        assert r["fpr"] == pytest.approx(fp / neg)
        assert r["precision_p"] == pytest.approx(tp / (tp + fp) if tp + fp else 0)
    recalls = [r["recall_p"] for r in got]
    assert recalls == sorted(recalls, reverse=True)


def test_eval_metrics_of_one_class_and_of_nothing(spark):
    one = spark.createDataFrame([(0.4, 1), (0.6, 1)], "p double, y int")
    assert {r["fpr"] for r in evaluate.eval_metrics(one, "y", "p").collect()} == {0.0}
    assert evaluate.eval_metrics(one.limit(0), "y", "p").count() == 0


def test_auc_is_unchanged_by_a_monotone_map(scored):
    df, rows = scored
    area = evaluate.roc_auc(df, "y", "p").first()[0]
    assert area == evaluate.roc_auc(df.withColumn("p", F.exp(F.col("p") * 3)), "y", "p").first()[0]
    pos = [p for _, p, y in rows if y == 1]
    neg = [p for _, p, y in rows if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    assert area == pytest.approx(wins / len(pos) / len(neg), abs=1e-5)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "p double, y int")
    assert evaluate.roc_auc(df, "y", "p").first()[0] is None
    assert {r["fpr"] for r in evaluate.roc_curve(df, "y", "p").collect()} == {None}


def test_roc_curve_ends_at_one_and_its_sample_stays_on_it(scored):
    df, rows = scored
    curve = evaluate.roc_curve(df, "y", "p")
    points = sorted(map(tuple, curve.collect()), reverse=True)
    assert points[-1][1:] == (1.0, 1.0) and len(points) == len({p for _, p, _ in rows})
    thresholds = {round(t, 5) for t, *_ in points}
    sample = evaluate.roc_sample(curve, 50).collect()
    assert len(sample) == 50 and {r["threshold"] for r in sample} <= thresholds
    assert sample[0]["threshold"] == round(points[-1][0], 5)


def test_class_metrics_of_a_class_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "c"), ("b", "a")], "y string, s string")
    got = {r["class"]: tuple(r)[1:] for r in evaluate.class_metrics(df, "y", "s").collect()}
    assert got == {"a": (0.5, 0.5, 0.5, 2), "b": (0.0, 0.0, 0.0, 1), "c": (0.0, 0.0, 0.0, 0)}


def test_matrix_of_many_classes_and_null_scores_in_bins(spark):
    many = spark.range(1500).select(F.col("id").alias("a"), ((F.col("id") + 1) % 1500).alias("p"))
    assert len(evaluate.confusion_matrix(many, "a", "p").columns) == 1501
    scored = spark.createDataFrame([(i, None if i < 5 else i / 10, i % 2) for i in range(10)], "id int, p double, y int")
    bins = evaluate.calibration_bins(scored, "id", "y", "p", bins=2).collect()
    assert {r["bin"] for r in bins if r["p"] is None} == {2}


def test_comparison_keeps_decimals(spark):
    one = spark.sql("SELECT CAST(1.5 AS DECIMAL(10,2)) AS d, 'x' AS t, 2 AS n")
    got = {r["col_name"]: r["mean_a"] for r in evaluate.dataset_compare(one, one).collect()}
    assert got == {"d": 1.5, "n": 2.0}
    assert evaluate.dataset_compare(one.select("t"), one).count() == 0


def test_calibration_bins_have_equal_counts(scored):
    df, rows = scored
    for bins in (7, 20, 4000):
        got = evaluate.calibration_bins(df, "id", "y", "p", bins).collect()
        order = [r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))]
        n, found = len(rows), {r["id"]: r["bin"] for r in got}
        per, extra = divmod(n, bins)
        want, at = {}, 0
        for b in range(1, bins + 1):
            for i in order[at : at + per + (b <= extra)]:
                want[i] = b
            at += per + (b <= extra)
        assert found == want


def test_p_value_cdf_stays_below_one_with_ties(spark):
    model = LinearModel(("a", "b", "c", "d"), (1.0,) * 4, (0.1, 0.1, 0.2, 0.3)).to_df(spark)
    assert [r["cdf"] for r in evaluate.p_value_cdf(model).orderBy("p_value").collect()] == [0.25, 0.5, 0.75]


def test_top_coefficients_use_the_unrounded_sign(spark):
    model = LinearModel(("a", "b", "constant_term", "d"), (0.001, -0.001, 9.0, 2.0), (0.01, 0.01, 0.0, 0.06)).to_df(spark)
    assert [tuple(r) for r in evaluate.top_coefficients(model).collect()] == [("a", 0.0, 0.01)]
    assert [r[0] for r in evaluate.top_coefficients(model, positive=False).collect()] == ["b"]
    assert [r[0] for r in evaluate.top_coefficients(model, level=None).collect()] == ["d", "a"]


def test_residual_ratio_ignores_bias(spark):
    df = spark.createDataFrame([(i, float(i), i + 100.0) for i in range(5)], "id int, y double, p double")
    assert {r["r_square"] for r in evaluate.residual_report(df, "id", "y", "p").collect()} == {1.0}


def test_flags_are_compared_as_numbers(spark):
    a = spark.createDataFrame([(True, 1.0, "x", True), (False, 2.0, "y", None)], "f boolean, g double, t string, h boolean")
    b = spark.createDataFrame([(True, True, "x", 5)], "f boolean, g boolean, t string, h int")
    found = {r["col_name"]: r for r in evaluate.dataset_compare(a, b).collect()}
    assert set(found) == {"f", "g", "h"}
    assert (found["f"]["mean_a"], found["f"]["mean_b"], found["f"]["mean_diff"]) == (0.5, 1.0, 0.5)
    assert (found["h"]["nulls_a"], found["h"]["max_b"]) == (1, 5.0)
