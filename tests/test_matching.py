import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradus.operators import matching


def _frame(spark, n, seed, values):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.35
        x = (3.0, 3.0, 3.0) if hot else tuple(float(rng.randrange(values)) for _ in range(3))
        rows.append((f"r{i:05d}", int(rng.random() < 0.3), *x))
    return spark.createDataFrame(rows, "id string, t int, a double, b double, c double").repartition(6), rows


def _brute(rows):
    x = np.array([r[2:] for r in rows])
    inverse = np.linalg.inv(np.cov(x.T))
    controls = sorted(r for r in rows if r[1] == 0)
    cx = np.array([r[2:] for r in controls])
    out = {}
    for r in rows:
        if r[1] == 1:
            gap = cx - np.array(r[2:])
            d = np.round(np.sqrt(np.einsum("ij,jk,ik->i", gap, inverse, gap)), 7)
            out[r[0]] = (controls[int(d.argmin())][0], d.min())
    return out


@pytest.mark.parametrize("values", [7, 1000])
def test_nearest_over_many_boxes_and_groups(spark, monkeypatch, values):
    monkeypatch.setattr(matching, "POINTS_PER_BOX", 10)
    monkeypatch.setattr(matching, "TREATED_PER_GROUP", 4)
    df, rows = _frame(spark, 900, values, values)
    want = _brute(rows)
    got = {r["id"]: (r["matched_id"], r["distance"]) for r in matching.match_nearest(df, "id", "t", ["a", "b", "c"]).collect()}
    assert got.keys() == want.keys()
    for i, (match, distance) in want.items():
        assert got[i][0] == match and got[i][1] == pytest.approx(distance, abs=2e-7)


def test_boxes_cover_space_and_hold_their_points():
    points = np.random.default_rng(1).integers(0, 6, size=(500, 2)).astype(float)
    boxes = matching.Boxes.around(points, 32)
    where = boxes.locate(points)
    assert set(where) == set(range(len(boxes.low)))
    assert (points > boxes.low[where] - 1e-12).all() and (points <= boxes.high[where]).all()
    for p, w in zip(points, where):
        assert boxes.distances(p[None], np.array([w]))[0] == 0
    reach = np.random.default_rng(2).random(500) * 2
    who, box, far = boxes.within(points, reach)
    every = np.array([[boxes.distances(p[None], np.array([b]))[0] for b in range(len(boxes.low))] for p in points])
    assert sorted(zip(who, box)) == [tuple(x) for x in np.argwhere(every <= reach[:, None])]
    assert np.allclose(far, every[who, box])


@pytest.mark.parametrize("k", [3, 4, 6])
def test_many_columns_against_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(matching, "POINTS_PER_BOX", 12)
    monkeypatch.setattr(matching, "NEXT_BOXES", 3)
    pick = np.random.default_rng(k)
    x = pick.integers(0, 9, size=(700, k)).astype(float) + np.where(pick.random((700, k)) < 0.3, 1e-9, 0.0)
    arm = (pick.random(700) < 0.3).astype(int)
    names = [f"c{j}" for j in range(k)]
    rows = [(i, int(a), *map(float, v)) for i, (a, v) in enumerate(zip(arm, x))]
    df = spark.createDataFrame(rows, "id int, t int, " + ", ".join(f"{n} double" for n in names)).repartition(5)
    found = {r["id"]: (r["matched_id"], r["distance"]) for r in matching.match_nearest(df, "id", "t", names).collect()}
    inverse = np.linalg.inv(np.cov(x.T))
    controls = np.flatnonzero(arm == 0)
    assert len(found) == arm.sum()
    for i in np.flatnonzero(arm):
        gap = x[controls] - x[i]
        d = np.sqrt(np.einsum("ij,jk,ik->i", gap, inverse, gap))
        chosen = int(np.flatnonzero(controls == found[i][0])[0])
        assert d[chosen] <= d.min() * (1 + 1e-12) + 1e-12 and found[i][1] == pytest.approx(d.min(), rel=1e-7, abs=1e-9)


def test_group_sizes_do_not_change_close_matches(spark, monkeypatch):
    rows = [(k, int(k % 4 == 0), 1 + (k * 37 % 101) * 1e-10, float(k % 3)) for k in range(600)]
    df = spark.createDataFrame(rows, "id int, t int, x double, y double")
    whole = {tuple(r) for r in matching.match_nearest(df, "id", "t", ["x", "y"]).collect()}
    monkeypatch.setattr(matching, "CONTROLS_PER_GROUP", 7)
    monkeypatch.setattr(matching, "POINTS_PER_BOX", 20)
    assert {tuple(r) for r in matching.match_nearest(df, "id", "t", ["x", "y"]).collect()} == whole
    near = spark.createDataFrame([(0, 1, 0.0), (1, 0, 1 + 4e-10), (2, 0, 1.0), (3, 0, 50.0)], "id int, t int, x double")
    assert matching.match_nearest(near, "id", "t", ["x"]).first()["matched_id"] == 2


def test_frontier_against_pruning_one_by_one(spark):
    rng = random.Random(9)
    for seed in range(3):
        rows = [(i, int(rng.random() < 0.3), rng.choice("aaab"), rng.randrange(4)) for i in range(60 + 40 * seed)] + [(999, 1, "only", 1), (998, None, "a", 1)]
        df = spark.createDataFrame(rows, "id int, t int, cell string, band int").repartition(4)
        rows = [r for r in rows if r[1] is not None]
        treated, left = [r for r in rows if r[1] == 1], sorted(r for r in rows if r[1] == 0)
        n_t, n_k = len(treated), len(left)
        cells = sorted({r[2:] for r in rows})

        def count(of):
            return {c: sum(r[2:] == c for r in of) for c in cells}

        t, want = count(treated), []
        while True:
            k = count(left)
            want.append((len(want), len(left), sum(abs(t[c] / n_t - k[c] / len(left)) for c in cells) / 2))
            excess = {c: k[c] * n_t - t[c] * n_k for c in cells}
            worst = min(cells, key=lambda c: (-excess[c], c))
            if excess[worst] <= 0:
                break
            left.remove(next(r for r in left if r[2:] == worst))
        found = matching.matching_frontier(df, "id", "t", ["cell", "band"]).orderBy("step").collect()
        assert [(r["step"], r["controls_left"]) for r in found] == [w[:2] for w in want]
        assert [r["imbalance"] for r in found] == pytest.approx([w[2] for w in want], abs=1e-12)
        assert len({r["id"] for r in found}) == len(found) and {r["id"] for r in found[1:]}.isdisjoint({r[0] for r in left})
    assert matching.matching_frontier(df.where("t = 1"), "id", "t", ["cell"]).count() == 0


def test_no_controls_and_collinear_columns(spark):
    df = spark.createDataFrame([(1, 1, 0.0, 0.0), (2, 1, 1.0, 2.0)], "id int, t int, a double, b double")
    assert matching.match_nearest(df, "id", "t", ["a", "b"]).count() == 0
    more = df.union(spark.createDataFrame([(3, 0, 5.0, 10.0), (4, 0, 0.9, 1.8)], df.schema))
    got = {r["id"]: r["matched_id"] for r in matching.match_nearest(more, "id", "t", ["a", "b"]).collect()}
    assert got == {1: 4, 2: 4}


def test_cells_pair_in_id_order_in_a_hot_cell(spark):
    rng = random.Random(4)
    rows = [(i, int(rng.random() < 0.4), "hot" if rng.random() < 0.7 else rng.choice("ab")) for i in range(1500)]
    df = spark.createDataFrame(rows, "id int, t int, cell string").repartition(9)
    want = {}
    for cell in ("hot", "a", "b"):
        treated = sorted(r[0] for r in rows if r[2] == cell and r[1] == 1)
        control = sorted(r[0] for r in rows if r[2] == cell and r[1] == 0)
        want |= dict(zip(treated, control))
    got = {r["id"]: r["matched_id"] for r in matching.match_cells(df, "id", "t", ["cell"]).collect()}
    assert got == want


def test_imbalance_of_equal_and_disjoint_arms(spark):
    equal = spark.createDataFrame([(0, "a"), (1, "a"), (0, "b"), (1, "b")], "t int, cell string")
    apart = spark.createDataFrame([(0, "a"), (1, "b")], "t int, cell string")
    assert matching.cell_imbalance(equal, "t", ["cell"]).first()[0] == 0
    assert matching.cell_imbalance(apart, "t", ["cell"]).first()[0] == 1


def test_matching_fills_nulls_and_honours_its_variables(spark):
    rows = [(1, 1.0, "y", 5, None), (2, 1.0, "n", 5, 1), (3, 2.0, "n", 9, 2)]
    df = spark.createDataFrame(rows, "id int, gpa double, t string, a int, b int")
    got = matching.matching(df, "id", "gpa", "t", ["a"], omit_nulls=False)
    assert [tuple(r) for r in got.collect()] == [(1, 2)] and dict(got.dtypes)["id"] == "int"
    assert matching.matching(df, "id", "gpa", "t").count() == 0
    with pytest.raises(ValueError, match="distance"):
        matching.matching(df, "id", "gpa", "t", distance="L3")


def test_factor_codes_sort_numbers(spark):
    df = spark.createDataFrame([(10, "n"), (9, "y"), (None, "y")], "a int, t string")
    got = matching.factor_codes(df, ["a"], "t").orderBy(F.col("t"), F.col("a")).collect()
    assert [tuple(r) for r in got] == [(2, 0), (None, 1), (1, 1)]


def test_factor_codes_of_every_type_and_many_values(spark, monkeypatch):
    monkeypatch.setattr(matching, "BROADCAST_ROW_LIMIT", 5)
    df = spark.range(300).select(
        "id", (F.col("id") % 7 - 3).alias("whole"), (F.col("id") % 90 / 8 - 2).alias("part"),
        F.concat(F.lit("t"), (F.col("id") % 40).cast("string")).alias("text"), (F.col("id") % 2 == 1).alias("flag"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 11).cast("int")).alias("day"),
        F.lit(None).cast("double").alias("gone"),
    )
    cols = ["whole", "part", "text", "flag", "day", "gone"]
    got = {r["id"]: r for r in matching.factor_codes(df, cols).collect()}
    rows = df.collect()
    for c in cols:
        order = {v: i for i, v in enumerate(sorted({r[c] for r in rows if r[c] is not None}), start=1)}
        assert all(got[r["id"]][c] == order.get(r[c]) for r in rows), c


def test_close_points_are_told_apart(spark):
    rows = [("t", 1, 0.0), ("far", 0, 5.0), ("c1", 0, 3e-9), ("c2", 0, 1e-9)]
    found = matching.match_nearest(spark.createDataFrame(rows, "id string, t int, x double"), "id", "t", ["x"])
    assert [(r["id"], r["matched_id"]) for r in found.collect()] == [("t", "c2")]


def test_a_box_with_most_controls_is_searched_in_parts(spark, monkeypatch):
    df, rows = _frame(spark, 1500, 4, 30)
    whole = {tuple(r) for r in matching.match_nearest(df, "id", "t", ["a", "b", "c"]).collect()}
    monkeypatch.setattr(matching, "CONTROLS_PER_GROUP", 40)
    monkeypatch.setattr(matching, "TREATED_PER_GROUP", 50)
    assert {tuple(r) for r in matching.match_nearest(df, "id", "t", ["a", "b", "c"]).collect()} == whole
