"""Array expressions used on feature vectors. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_at(values: Column, position: int) -> Column:
    """Array without the element at the 1-based ``position``."""
    return F.filter(values, lambda _, i: i != position - 1)


def keep_where(values: Column, mask: Column) -> Column:
    """Elements whose 0/1 mask entry is 1, order kept; a null mask entry drops."""
    paired = F.zip_with(values, mask, lambda v, m: F.struct(v.alias("v"), m.alias("m")))
    return F.transform(F.filter(paired, lambda p: p["m"] == 1), lambda p: p["v"])


def dot(left: Column, right: Column) -> Column:
    """Inner product of two arrays of doubles."""
    products = F.zip_with(left, right, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def array_length(values: Column) -> Column:
    """Upper index of a 1-based array: its length, or null when it is empty."""
    return F.when(F.size(values) > 0, F.size(values))


def unnest_together(df: DataFrame, keep: list[str], **arrays: Column) -> DataFrame:
    """Expand several arrays side by side, one output row per position."""
    zipped = F.arrays_zip(*[a.alias(name) for name, a in arrays.items()])
    named = F.transform(
        zipped, lambda s: F.struct(*[s[name].alias(name) for name in arrays])
    )
    return df.select(*keep, F.inline(named))
