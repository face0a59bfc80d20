import random
from datetime import datetime, timedelta

import pytest

from gradus.operators import intervals
from gradus.operators.intervals import interval_counts, interval_join


def brute(points, spans, closed, keyed):
    return sorted(
        (p[0], s[0]) for p in points for s in spans
        if p[2] is not None and s[2] is not None and s[3] is not None and (not keyed or p[1] == s[1])
        and s[2] <= p[2] and (p[2] <= s[3] if closed else p[2] < s[3])
    )


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("closed", [True, False])
def test_lengths_of_every_size(spark, keyed, closed):
    rng = random.Random(6)
    points = [(i, rng.randrange(3), rng.randrange(-5000, 5000)) for i in range(400)] + [(900, 1, None), (901, None, 7)]
    spans = []
    for i in range(150):
        start = rng.randrange(-6000, 5000)
        spans.append((i, rng.randrange(3), start, start + rng.choice([0, 0, 1, 2, 3, 7, 8, 64, 1000, 1 << 20])))
    spans += [(500, 1, None, 5), (501, 1, 5, None), (502, 1, 9, 3), (503, None, -9999, 9999)]
    p = spark.createDataFrame(points, "pid int, key int, at long").repartition(5)
    s = spark.createDataFrame(spans, "sid int, key int, low long, high long").repartition(4)
    if not keyed:
        s = s.withColumnRenamed("key", "other")
    found = interval_join(p, s, "at", "low", "high", on=["key"] if keyed else [], closed=closed)
    want = brute(points, spans, closed, keyed)
    if keyed:
        want = [w for w in want if w[0] != 901 and w[1] != 503]
    assert sorted((r["pid"], r["sid"]) for r in found.collect()) == want
    every = interval_join(p, s, "at", "low", "high", on=["key"] if keyed else [], closed=closed, how="left").collect()
    met = {w[0] for w in want}
    assert sorted((r["pid"], r["sid"]) for r in every if r["sid"] is not None) == want
    assert sorted(r["pid"] for r in every if r["sid"] is None) == sorted(q[0] for q in points if q[0] not in met)


def test_times_and_dates(spark):
    day = datetime(2020, 2, 28)
    p = spark.createDataFrame([(k, day + timedelta(hours=k)) for k in range(100)], "pid int, at timestamp_ntz")
    s = spark.createDataFrame([(1, day, day + timedelta(hours=3, microseconds=-1)), (2, day + timedelta(hours=50), day + timedelta(hours=50))], "sid int, low timestamp_ntz, high timestamp_ntz")
    assert sorted((r["pid"], r["sid"]) for r in interval_join(p, s, "at", "low", "high").collect()) == [(0, 1), (1, 1), (2, 1), (50, 2)]
    days = interval_join(
        p.selectExpr("pid", "cast(at as date) as at"), s.selectExpr("sid", "cast(low as date) as low", "cast(high as date) as high"), "at", "low", "high"
    )
    assert days.where("sid = 1").count() == 24 and days.where("sid = 2").count() == 24


def test_nothing_to_meet_and_wrong_calls(spark):
    p = spark.createDataFrame([(1, 5)], "pid int, at long")
    s = spark.createDataFrame([], "sid int, low long, high long")
    assert interval_join(p, s, "at", "low", "high").count() == 0
    assert [tuple(r) for r in interval_join(p, s, "at", "low", "high", how="left").collect()] == [(1, 5, None, None, None)]
    with pytest.raises(ValueError, match="both frames"):
        interval_join(p, s.withColumnRenamed("sid", "pid"), "at", "low", "high")
    with pytest.raises(ValueError, match="how"):
        interval_join(p, s, "at", "low", "high", how="full")
    with pytest.raises(ValueError, match="different kinds"):
        interval_join(p, s.withColumn("high", s["high"].cast("timestamp")), "at", "low", "high")


def test_a_long_interval_is_not_unfolded(spark):
    s = spark.createDataFrame([(1, 0, 1 << 60)], "sid int, low long, high long")
    p = spark.range(1000).selectExpr("id as pid", "id * 1000003 as at")
    assert interval_join(p, s, "at", "low", "high").count() == 1000


@pytest.mark.parametrize("closed", [True, False])
def test_counts_without_pairs(spark, closed, monkeypatch):
    monkeypatch.setattr(intervals, "CHUNK_BITS", 4)
    rng = random.Random(8)
    points = [(rng.choice([None, *range(9)]), rng.randrange(300)) for _ in range(500)] + [(1, None)]
    spans = [(g, a, a + rng.choice([0, 1, 5, 40, 200])) for g in range(60) for a in [rng.randrange(-20, 310)]]
    spans += [(g, a, a + 30) for g in (None, 3, 90, 91) for a in (10, 20, 20, 150)] + [(92, 5, None), (93, 9, 3), (94, 7, 250), (94, 7, 250), (95, 900, 950)]
    want = {}
    for g, a, b in spans:
        for who, t in points:
            if b is not None and t is not None and a <= t and (t <= b if closed else t < b):
                n, users = want.setdefault(g, [0, set()])
                want[g][0] += 1
                users |= {who} - {None}
    p = spark.createDataFrame(points, "who int, at long").repartition(5)
    s = spark.createDataFrame(spans, "sid int, low long, high long").repartition(4)
    found = interval_counts(p, s, "at", "low", "high", "sid", "who", closed=closed).collect()
    assert len(found) == len(want)
    assert {r["sid"]: (r["n"], r["users"]) for r in found} == {g: (n, len(u)) for g, (n, u) in want.items()}


def test_counts_grow_with_the_rows_not_the_pairs(spark):
    """Two hundred million pairs, which a join would list."""
    p = spark.range(20_000).selectExpr("id % 50 as who", "id as at")
    s = spark.range(10_000).selectExpr("id as sid", "0L as low", "1000000L + id as high")
    found = interval_counts(p, s, "at", "low", "high", "sid", "who")
    assert [tuple(r) for r in found.groupBy("n", "users").count().collect()] == [(20_000, 50, 10_000)]
