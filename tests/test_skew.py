import pytest
from pyspark.sql import functions as F

from gradus.operators import assemble, skew


@pytest.fixture()
def eager(monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 50)


def test_hot_values_include_null_and_stay_few(spark, eager):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), "id")).alias("k")
    )
    found = skew.hot_values(df, ["k"])["k"]
    assert found.values == ("hot",) and found.missing and found.salts == 3
    assert skew.hot_values(df.where("k like 'k%'"), ["k"]) == {}


def test_assembly_with_hot_and_missing_keys(spark, eager, monkeypatch):
    n = 900
    base = spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("person_uid"),
        (F.col("id") % 5).alias("academic_period"),
    )
    persons = spark.range(n).select(F.col("id").alias("person_uid"), (F.col("id") * 2).alias("f"))
    doubled = persons.where("person_uid = 7").union(persons)
    terms = spark.range(n * 5).groupBy(
        (F.col("id") % n).alias("person_uid"), (F.floor(F.col("id") / n)).alias("academic_period")
    ).agg(F.max("id").alias("g"))
    tables = {"terms": terms, "persons": doubled}
    rules = assemble.FeatureRules(exclude=("person_uid", "academic_period"))
    split = assemble.assemble_features(base, tables, rules)
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 1 and "_salt" in plan  # the one that the test makes
    monkeypatch.setattr(skew, "HOT_ROWS", 10**9)
    whole = assemble.assemble_features(base, tables, rules)
    assert split.columns == whole.columns == ["id", "person_uid", "academic_period", "g", "f"]
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
    assert split.count() == n + n // 3 + 1


def test_joins_of_one_leading_key_move_the_base_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.range(100).select(F.col("id").alias("person_uid"), F.col("id").alias("academic_period"))
        persons = spark.range(100).select(F.col("id").alias("person_uid"), F.col("id").alias("f"))
        terms = base.withColumn("g", F.lit(1))
        rules = assemble.FeatureRules(exclude=("person_uid", "academic_period"))
        plan = assemble.assemble_features(base, {"t": terms, "p": persons}, rules)
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 2 and text.count("Exchange") == 3


def test_base_is_read_once_whatever_is_hot(spark, eager, tmp_path):
    """Three hot leading keys: one scan of the base and three joins."""
    n = 600
    hot = F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id"))
    spark.range(n).select("id", *[hot.alias(k) for k in ("a", "b", "c")]).write.parquet(f"{tmp_path}/base")
    base = spark.read.parquet(f"{tmp_path}/base")
    tables = {
        f"t{k}": spark.range(n).select(F.col("id").alias(k), (F.col("id") * 3).alias(f"f{k}")) for k in ("a", "b", "c")
    }
    rules = assemble.FeatureRules(
        exclude=("a", "b", "c"), custom_joins={f"t{k}": [k] for k in ("a", "b", "c")}
    )
    found = assemble.assemble_features(base, tables, rules)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("Join LeftOuter") == 3
    got = found.collect()
    assert len(got) == n and all(r["fa"] == r["a"] * 3 and r["fc"] == r["c"] * 3 for r in got)


def test_year_level_join_with_hot_and_missing_persons(spark, eager):
    base = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, 5).when(F.col("id") % 4 == 1, F.col("id")).alias("person_uid"),
        F.lit("201510").alias("academic_period"),
    )
    aid = spark.createDataFrame([(5, "2015", 1.5), (9, "2015", 2.5), (None, "2015", 9.0)], "person_uid long, aid_year string, f double")
    got = assemble.join_year_level(base, aid)
    assert got.columns == ["person_uid", "academic_period", "f"] and got.count() == 400
    assert got.where("f = 1.5").count() == 201 and got.where("f = 2.5").count() == 1
