import datetime as dt

import pytest
from pyspark.sql import functions as F

from gradus import sources
from gradus.session import broadcast_if_small, materialise, shared_folder


def test_catalog_orders_and_filters(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "z int, b string, a double")
    assert sources.column_catalog(df) == [("z", "int"), ("b", "string"), ("a", "double")]
    assert sources.column_catalog(df, exclude=["b"], by_name=True) == [("a", "double"), ("z", "int")]
    assert sources.column_catalog(df, types=["string"]) == [("b", "string")]


def test_replace_and_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "x,y"), (2, None)], "a int, b string")
    target = str(tmp_path / "t")
    sources.replace_table(df, target)
    sources.replace_table(df.limit(1), target)
    assert spark.read.parquet(target).count() == 1
    out = tmp_path / "csv"
    sources.export_csv(df, str(out), single_file=True)
    (file,) = out.glob("*.csv")
    assert file.read_text().splitlines() == ["a,b", '1,"x,y"', "2,"]


def test_materialise_keeps_types_and_cuts_the_plan(spark):
    df = spark.range(5).select("id", F.array("id").alias("v"), F.lit(None).cast("date").alias("d"), F.col("id").alias("a.b"))
    copy = materialise(df)
    assert copy.dtypes == df.dtypes and sorted(map(tuple, copy.collect())) == sorted(map(tuple, df.collect()))
    assert "Range" not in copy._jdf.queryExecution().optimizedPlan().toString()
    assert shared_folder(spark)


def test_broadcast_only_what_was_counted(spark):
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(broadcast_if_small(spark.range(10), 10))
    assert "broadcast" not in plan(broadcast_if_small(spark.range(11), 10))


@pytest.fixture(scope="module")
def builds(spark):
    rows = [
        ("a", "CREATE", "TABLE", dt.datetime(2016, 1, 1, 23, 59)),
        ("a", "CREATE", "TABLE", dt.datetime(2016, 3, 1, 1, 0)),
        ("a", "CREATE", "INDEX", dt.datetime(2016, 6, 1)),
        ("b", "CREATE", "TABLE", dt.datetime(2015, 9, 1)),
        ("c", "VACUUM", "", dt.datetime(2016, 6, 1)),
    ]
    return spark.createDataFrame(rows, "table_name string, action string, subtype string, ts timestamp")


def test_stale_needs_more_than_the_age_and_a_known_build(builds):
    last = {r[0]: r[1] for r in sources.last_builds(builds).collect()}
    assert last == {"a": dt.date(2016, 3, 1), "b": dt.date(2015, 9, 1)}
    day = dt.date(2016, 3, 31)
    assert [r[0] for r in sources.stale_tables(builds, day, 30).collect()] == ["b"]
    assert {r[0] for r in sources.stale_tables(builds, day, 29).collect()} == {"a", "b"}


def test_unknown_terms_never_refresh(spark, builds):
    calendar = spark.createDataFrame(
        [("201610", dt.date(2016, 1, 1), dt.date(2016, 5, 31)), ("201630", dt.date(2016, 6, 1), dt.date(2016, 8, 1))],
        "academic_period string, start_date date, end_date date",
    )
    changed = sources.term_changed_tables(builds, dt.date(2016, 7, 1), calendar)
    assert [(r["table_name"], r["last_term"], r["current_term"]) for r in changed.collect()] == [("a", "201610", "201630")]
    assert sources.term_changed_tables(builds, dt.date(2020, 1, 1), calendar).count() == 0
    assert sources.current_term(calendar, dt.date(2016, 6, 1)).first()[0] == "201630"


def test_ledger_replaces_one_part_alone(spark, tmp_path):
    from gradus.sources.ledger import Ledger

    book = Ledger(spark, str(tmp_path / "book"))
    assert book.finished("a run") == [] and book.rows("a run") is None
    for part in (1, 2, 11):
        book.append("a run", part, spark.range(part).selectExpr("id", "'first' AS said"))
    book.append("other/run", 1, spark.range(5))
    book.append("a run", 2, spark.range(1).selectExpr("id", "'second' AS said"))
    assert book.finished("a run") == [1, 2, 11] and book.finished("other/run") == [1]
    found = book.rows("a run").groupBy("part", "said").count().collect()
    assert sorted(map(tuple, found)) == [(1, "first", 1), (2, "second", 1), (11, "first", 11)]
    (tmp_path / "book" / "run=a%20run" / "part=2" / "_SUCCESS").unlink()
    assert book.finished("a run") == [1, 11] and book.rows("a run").count() == 12
    assert book.part("other/run", 1).count() == 5
