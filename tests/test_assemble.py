import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from gradus.functions.scalars import dated_name
from gradus.operators import assemble
from gradus.plans import specs


def test_rules_are_unanchored_and_look_ahead():
    columns = ["hs_state_in", "hs_state_ny", "x_hs_nation_us", "profile_academic_period", "profile_gpa", "HS_NATION_A", "puid"]
    chosen = assemble.select_feature_columns(columns, specs.IDENTITY_COLUMNS, (specs.NATION, specs.STATE, specs.PROFILE_BUT_TERM))
    assert chosen == ["hs_state_in", "profile_academic_period", "HS_NATION_A"]


def test_join_keys_in_order_or_error():
    assert assemble.detect_join_keys(["x", "academic_period", "person_uid"]) == ["person_uid", "academic_period"]
    with pytest.raises(ValueError, match="join keys"):
        assemble.detect_join_keys(["x"])


def test_sources_in_the_order_asked():
    groups = {"sis": ("a", "b"), "lms": ("c",)}
    assert assemble.select_sources(groups, ["lms", "nope", "sis"]) == ["c", "a", "b"]
    assert assemble.skip_non_feature_tables(["a", "b"], ["a"]) == ["b"]


def test_duplicate_feature_names_raise(spark):
    base = spark.createDataFrame([(1, 2)], "person_uid int, x int")
    with pytest.raises(ValueError, match="already present"):
        assemble.assemble_features(base, {"t": base}, assemble.FeatureRules(exclude=("person_uid",)))


def test_fan_out_null_keys_and_custom_joins(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "person_uid int, k string")
    doubled = spark.createDataFrame([(1, 10), (1, 11), (None, 12)], "person_uid int, f int")
    other = spark.createDataFrame([("b", 5)], "k string, g int")
    rules = assemble.FeatureRules(exclude=("person_uid", "k"), custom_joins={"o": ["k"]})
    got = assemble.assemble_features(base, {"d": doubled, "o": other}, rules)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "a", 10, None), (1, "a", 11, None), (2, "b", None, 5), (None, "c", None, None)], key=str
    )


def test_dated_names():
    assert dated_name("t", date(2016, 6, 5)) == "t_05_Jun_2016"
    assert dated_name("t", date(2016, 6, 5), lower_month=True) == "t_05_jun_2016"


def test_specs_hold_the_rules():
    grade = specs.grade_spec("own")
    assert len(grade.feature_tables()) == 26
    assert grade.feature_tables(["netlog"]) == ["features_network.attendance_by_person_course"]
    assert "avg_arrival_prompt_lbp" in grade.rules.exclude and "sched_type_complex_" in grade.rules.exclude
    assert len(grade.rules.exclude) == 10 + 24 + 20 + 20 + 2
    assert len(specs.AT_RISK_2017.feature_tables()) == 14 and len(specs.AT_RISK_2016.feature_tables()) == 13
    assert specs.RACE in specs.AT_RISK_2017.rules.exclude_regex
    assert specs.RACE not in specs.AT_RISK_2016.rules.exclude_regex


def test_term_split_leaves_out_unknown_terms(spark):
    df = spark.createDataFrame([("201510",), ("201710",), ("201810",), (None,)], "term string")
    train, score = assemble.term_split(df, 201710, ["201710"], "term")
    assert [r[0] for r in train.collect()] == ["201510"] and [r[0] for r in score.collect()] == ["201710"]


def test_clustered_tables_are_joined_where_they_lie(spark):
    from gradus.operators.assemble import assemble_features, assemble_stored
    from gradus.sources.tables import store_clustered

    base = spark.range(5000).select((F.col("id") % 4000).alias("person_uid"), F.col("id").alias("pk1"))
    base = base.unionByName(spark.createDataFrame([(None, -1)], base.schema))
    plain = [
        spark.range(0, 4000, k + 1).select(F.col("id").alias("person_uid"), (F.col("id") * k).alias(f"f{k}"))
        for k in range(6)
    ]
    run = uuid.uuid4().hex[:12]
    stored = [store_clustered(t, f"clustered_{k}_{run}", "person_uid", 4) for k, t in enumerate(plain)]
    together = assemble_stored(store_clustered(base, f"clustered_base_{run}", "person_uid", 4), stored)
    plan = together._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 6
    rules = assemble.FeatureRules(exclude=("person_uid",))
    want = assemble_features(base, {f"s.t{k}": t for k, t in enumerate(plain)}, rules).select(together.columns)
    assert together.exceptAll(want).count() == 0 and want.exceptAll(together).count() == 0 and want.count() == 5001
    with pytest.raises(ValueError, match="several tables"):
        assemble_stored(base, [plain[1], plain[1]])
    for name in (*range(6), "base"):
        spark.sql(f"DROP TABLE clustered_{name}_{run}")


def test_a_task_sorts_for_few_joins_of_bounded_size(spark, monkeypatch):
    base = spark.range(3000).select((F.col("id") % 2000).alias("person_uid"), F.col("id").alias("pk1"))
    base = base.unionByName(spark.createDataFrame([(None, -1)], base.schema))
    tables = {f"t{k}": spark.range(0, 2000, k + 1).select(F.col("id").alias("person_uid"), (F.col("id") * k).alias(f"f{k}")) for k in range(6)}
    rules = assemble.FeatureRules(exclude=("person_uid",))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = assemble.assemble_features(base, tables, rules)
        want = sorted(map(str, plain.collect()))
        monkeypatch.setattr(assemble, "TASK_BYTES", 1 << 16)
        monkeypatch.setattr(assemble, "BROADCAST_ROW_LIMIT", 100)
        found = assemble.assemble_features(base, tables, rules)
        assert sorted(map(str, found.collect())) == want and found.rdd.getNumPartitions() > 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The fifth join sorts the rows anew; of large tables, every side has its number of partitions.
    assert plain._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1
    assert found._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 8
    assert found.count() == 3001
