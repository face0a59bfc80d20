"""Registry of queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of (spark, folder) under its name, with its SQL if any."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(configure(spark), folder)

        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(value: Column | str, places: int = 6) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, places)


def round_sql(value: str, places: int = 6) -> str:
    """Rounding in SQL that never yields a negative zero."""
    return f"(round(CAST({value} AS DOUBLE), {places}) + 0.0)"
