"""Build log and calendar look-ups that decide which tables are due.

A build log has the columns table_name, action, subtype and ts; a calendar has
academic_period, start_date and end_date.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.session import broadcast_if_small


def last_builds(build_log: DataFrame) -> DataFrame:
    """Day of the newest table creation for every table in the log.

    A maximum combines on the map side, so a table built very often costs no
    more to shuffle than one built once.
    """
    created = build_log.where((F.col("action") == "CREATE") & (F.col("subtype") == "TABLE"))
    return created.groupBy("table_name").agg(F.max("ts").cast("date").alias("last_build"))


def calendar_days(calendar: DataFrame) -> DataFrame:
    """One row per day and term, so looking up a date is an equi join."""
    days = F.sequence("start_date", "end_date", F.expr("interval 1 day"))
    valid = calendar.where(F.col("start_date") <= F.col("end_date"))
    return valid.select("academic_period", F.explode(days).alias("term_day"))


def term_of(df: DataFrame, day: Column, calendar: DataFrame, name: str = "academic_period") -> DataFrame:
    """Add the term that contains ``day``; null outside every term."""
    days = calendar_days(calendar).withColumnRenamed("academic_period", name)
    keyed = df.withColumn("_day", day.cast("date"))
    joined = keyed.join(broadcast_if_small(days), keyed["_day"] == days["term_day"], "left")
    return joined.drop("_day", "term_day")


def current_term(calendar: DataFrame, day: date) -> DataFrame:
    """The term or terms that contain a given day."""
    inside = F.lit(day).between(F.col("start_date"), F.col("end_date"))
    return calendar.where(inside).select("academic_period")


def _with_last_build(tables: DataFrame, build_log: DataFrame) -> DataFrame:
    return tables.select("table_name").distinct().join(last_builds(build_log), "table_name", "left")


def stale_tables(
    build_log: DataFrame, as_of: date, max_age_days: int, tables: DataFrame | None = None
) -> DataFrame:
    """Tables last built more than ``max_age_days`` before ``as_of``.

    A table with no known build is not stale, because its age compares to null.
    """
    builds = _with_last_build(build_log if tables is None else tables, build_log)
    age = F.datediff(F.lit(as_of), F.col("last_build"))
    return builds.withColumn("age_days", age).where(F.col("age_days") > max_age_days)


def term_changed_tables(
    build_log: DataFrame, as_of: date, calendar: DataFrame, tables: DataFrame | None = None
) -> DataFrame:
    """Tables whose last build fell in another term than ``as_of`` does.

    Where either term is unknown the table is left alone.
    """
    builds = _with_last_build(build_log if tables is None else tables, build_log)
    termed = term_of(builds, F.col("last_build"), calendar, "last_term")
    now = termed.withColumn("_now", F.lit(as_of))
    compared = term_of(now, F.col("_now"), calendar, "current_term").drop("_now")
    return compared.where(F.col("last_term") != F.col("current_term"))
