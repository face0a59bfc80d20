"""Scalar expressions: keyed hashing, id clean-up, guards, generated names."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_uniform(seed: int | str, *key: Column) -> Column:
    """Uniform number in [0, 1) fixed by the seed and the key.

    The first 32 bits of an md5 give the same value in any engine, on any
    partitioning and after any retry, which a random generator does not.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def normalize_id(value: Column) -> Column:
    """Text before the first dot, so '123.0' becomes '123'."""
    return F.substring_index(value.cast("string"), ".", 1)


def year_digits(value: Column) -> Column:
    """Third and fourth character of a term or year code."""
    return F.substring(value.cast("string"), 3, 2)


def schema_part(name: Column) -> Column:
    return F.split_part(name, F.lit("."), F.lit(1))


def table_part(name: Column) -> Column:
    return F.split_part(name, F.lit("."), F.lit(2))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio whose zero denominator counts as 0.001."""
    safe = F.when(denominator == 0, F.lit(0.001)).otherwise(denominator.cast("double"))
    return numerator.cast("double") / safe


def fixed_text(value: Column, places: int = 5) -> Column:
    """A number as text with this many decimals, such as 0.50000."""
    return F.round(value.cast("double"), places).cast(f"decimal(38,{places})").cast("string")


def balanced_sum(terms: list[Column]) -> Column:
    """Sum of many columns as a balanced tree, which keeps plans shallow."""
    if not terms:
        return F.lit(0.0)
    while len(terms) > 1:
        pairs = [terms[i] + terms[i + 1] for i in range(0, len(terms) - 1, 2)]
        terms = pairs + ([terms[-1]] if len(terms) % 2 else [])
    return terms[0]


def dated_name(prefix: str, day: date, lower_month: bool = False) -> str:
    """Table name with a day stamp such as 05_Jan_2024."""
    month = day.strftime("%b")
    return f"{prefix}_{day:%d}_{month.lower() if lower_month else month}_{day:%Y}"
