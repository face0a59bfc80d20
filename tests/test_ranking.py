import random

import pytest
from pyspark.sql import functions as F

from gradus.operators.ranking import global_row_number, range_sorted, running_totals


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for i in range(6000):
        group = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None, "z"])
        out.append((group, rng.randrange(40), i, rng.randrange(5)))
    return out


def test_running_totals_across_partitions_of_a_hot_group(spark, rows):
    df = spark.createDataFrame(rows, "g string, o int, i int, v int").repartition(11)
    found = running_totals(df, {"total": F.col("v"), "n": F.lit(1)}, [F.col("o").desc(), F.col("i")], within=["g"])
    got = {r["i"]: (r["total"], r["n"]) for r in found.collect()}
    sums = {}
    for g, _, i, v in sorted(rows, key=lambda r: (-r[1], r[2])):
        total, n = sums.get(g, (0, 0))
        sums[g] = (total + v, n + 1)
        assert got[i] == sums[g]
    assert len(got) == len(rows)


def test_running_totals_without_groups(spark, rows):
    df = spark.createDataFrame(rows, "g string, o int, i int, v int")
    got = {r["i"]: r["t"] for r in running_totals(df, {"t": F.col("v")}, [F.col("i")]).collect()}
    total = 0
    for *_, i, v in sorted(rows, key=lambda r: r[2]):
        total += v
        assert got[i] == total


def test_global_row_number_with_ties_in_the_first_column(spark, rows):
    df = spark.createDataFrame(rows, "g string, o int, i int, v int").repartition(5)
    got = global_row_number(df, [F.col("v"), F.col("i").desc()]).collect()
    want = [r[2] for r in sorted(rows, key=lambda r: (r[3], -r[2]))]
    assert [r["i"] for r in sorted(got, key=lambda r: r["row_number"])] == want


def test_rows_are_not_moved_again_once_sorted(spark, rows):
    """Only the totals of the partitions are exchanged and windowed; the written rows meet them by broadcast."""
    df = spark.createDataFrame(rows, "g string, o int, i int, v int")
    found = running_totals(df, {"n": F.lit(1)}, [F.col("i")], within=["g"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    rows_side = plan[plan.index("BroadcastHashJoin") :].split("BroadcastExchange")[0]
    assert "hashpartitioning" not in rows_side and "Window" not in rows_side


def test_running_totals_of_missing_values_and_fractions(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i / 2) for i in range(500)], "i int, v double").repartition(7)
    got = {r["i"]: r["t"] for r in running_totals(df, {"t": F.col("v")}, [F.col("i")]).collect()}
    total = 0.0
    for i in range(500):
        total += 0 if i % 4 == 0 else i / 2
        assert got[i] == pytest.approx(total)


def test_ranges_are_several_here_and_merge_by_default(spark, rows):
    df = spark.createDataFrame(rows, "g string, o int, i int, v int")
    parts = lambda: range_sorted(df, [F.col("i")]).select(F.shiftright("_at", 33)).distinct().count()
    assert parts() > 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        assert parts() == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, i int")
    assert running_totals(df, {"n": F.lit(1)}, [F.col("i")], within=["g"]).count() == 0
    assert global_row_number(df, [F.col("i")]).count() == 0


def test_a_hot_missing_group_spans_partitions(spark):
    rows = [(None if i % 3 else "a", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, i int").repartition(6)
    got = {r["i"]: r["n"] for r in running_totals(df, {"n": F.lit(1)}, [F.col("i")], within=["g"]).collect()}
    for group in (None, "a"):
        members = sorted(i for g, i in rows if g == group)
        assert [got[i] for i in members] == list(range(1, len(members) + 1))
