import random

import pytest
from pyspark.sql import functions as F

from gradus.functions import array_length, drop_at, keep_where, normalize_id
from gradus.operators import prep, split


def test_drop_duplicate_keys_with_hot_and_null_keys(spark):
    rng = random.Random(1)
    rows = [("hot", i) for i in range(3000)] + [(None, i) for i in range(500)]
    rows += [(f"k{rng.randrange(3000)}", i) for i in range(4000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, v int").repartition(16)
    seen = {}
    for key, _ in rows:
        seen[key] = seen.get(key, 0) + 1
    want = sorted(((k, v) for k, v in rows if k is None or seen[k] == 1), key=str)
    once = prep.drop_duplicate_keys(df, "key")
    assert sorted(map(tuple, once.collect()), key=str) == want
    assert sorted(map(tuple, prep.drop_duplicate_keys(once, "key").collect()), key=str) == want
    surplus = sum(n - 1 for n in seen.values())
    assert prep.duplicate_row_count(df, "key").first()[0] == surplus


def test_hot_key_collapses_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("a").alias("key"), "id")
    plan = prep.drop_duplicate_keys(df, "key")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") >= 1 and "Window" not in plan and "Join" not in plan


def test_duplicate_row_count_of_nothing(spark):
    assert prep.duplicate_row_count(spark.createDataFrame([], "key int"), "key").first()[0] == 0


def _messy(spark):
    rows = [(1, 1.0, None, 5, True, 1), (2, None, None, 5, False, 0), (3, 4.0, None, 5, None, None)]
    return spark.createDataFrame(rows, "id int, a double, gone double, same int, flag boolean, label int")


def test_impute_normalize_keeps_raw_nulls_and_drops_flat_columns(spark):
    out = prep.impute_normalize(_messy(spark), "id", "label", constant_term=True).orderBy("id").collect()
    assert out[0]["feat_name_vect"] == ["a", "constant_term", "flag"]
    assert out[1]["feat_vect"] == [None, 1.0, 0.0]
    assert out[1]["feat_vect_normalized"][0] == 0.0 and out[2]["feat_vect_normalized"][2] == 0.0
    for position in (0, 2):
        assert abs(sum(r["feat_vect_normalized"][position] for r in out)) < 1e-12
    assert out[2]["label"] is None


def test_impute_normalize_is_a_projection(spark):
    plan = prep.impute_normalize(_messy(spark), "id", "label")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_no_features_is_an_error(spark):
    with pytest.raises(ValueError, match="no feature columns"):
        prep.impute_normalize(_messy(spark), "id", exclude=["a", "gone", "same", "flag", "label"])


def test_flat_features_and_unknown_exclusions_are_reported(spark):
    with pytest.raises(ValueError, match="varies"):
        prep.impute_normalize(_messy(spark), "id", exclude=["a", "flag", "label"])
    with pytest.warns(UserWarning, match="nowhere"):
        prep.feature_names(_messy(spark), ["nowhere"])


def test_apply_mask_keeps_order_and_may_empty(spark):
    vectors = prep.impute_normalize(_messy(spark), "id", "label")
    assert prep.apply_mask(vectors, [0, 1]).first()["feat_name_vect"] == ["flag"]
    assert prep.apply_mask(vectors, [0, 0]).first()["feat_vect"] == []


def test_drop_all_null_columns_and_mode(spark):
    assert prep.drop_all_null_columns(_messy(spark)).columns == ["id", "a", "same", "flag", "label"]
    df = spark.createDataFrame([("b", 1.0), ("a", None), ("b", 3.0), (None, 2.0), ("a", 2.0)], "t string, x double")
    filled = prep.impute_mean_or_mode(df).collect()
    assert [r["t"] for r in filled].count("a") == 3
    assert [r["x"] for r in filled].count(2.0) == 3


def test_array_helpers(spark):
    row = spark.range(1).select(
        drop_at(F.array(*map(F.lit, (7, 8, 9))), 2).alias("dropped"),
        keep_where(F.array(*map(F.lit, (1, 3, 4, 5))), F.array(*map(F.lit, (0, 1, 1, 0)))).alias("kept"),
        array_length(F.array()).alias("none"),
        array_length(F.array(F.lit(1))).alias("one"),
        normalize_id(F.lit("123.0")).alias("cut"),
        normalize_id(F.lit("123")).alias("plain"),
    ).first()
    assert list(row) == [[7, 9], [3, 4], None, 1, "123", "123"]


def test_group_cumulative_split_keeps_units_whole_and_survives_a_hot_unit(spark):
    rows = [("t1", "a" if i < 900 else f"u{i % 50}", i) for i in range(1800)]
    rows += [("t2", None if i < 20 else f"v{i % 9}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "term string, unit string, i int").repartition(7)
    out = split.group_cumulative_split(df, "term", "unit").collect()
    assert len(out) == len(rows)
    for term, total in (("t1", 1800), ("t2", 300)):
        sizes, marks = {}, {}
        for r in out:
            if r["term"] == term and r["unit"] is not None:
                sizes[r["unit"]] = sizes.get(r["unit"], 0) + 1
                marks.setdefault(r["unit"], set()).add(r["train_set"])
        cume = 0
        for unit in sorted(sizes):
            cume += sizes[unit]
            assert marks[unit] == {int(cume < total * 0.8)}
    assert {r["train_set"] for r in out if r["unit"] is None} == {0}


def test_random_split_is_complementary_and_stable(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 7 != 0, 1).alias("y"))
    train, test = split.random_split(df, "id", "y", 0.8)
    ids = {r[0] for r in train.select("id").collect()}, {r[0] for r in test.select("id").collect()}
    assert not ids[0] & ids[1] and len(ids[0] | ids[1]) == df.where("y is not null").count()
    again = split.random_split(df.repartition(13), "id", "y", 0.8)[0]
    assert {r[0] for r in again.select("id").collect()} == ids[0]


def test_capped_test_set(spark):
    df = spark.range(1000).select("id", F.lit(1).alias("y"))
    train, test = split.random_or_column_split(df, "id", "y", 0.5)
    assert test.count() == 200 and 400 < train.count() < 600
