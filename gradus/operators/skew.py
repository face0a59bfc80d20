"""Hot join keys: finding them all in one pass and spreading their rows.

Adaptive execution splits a hot partition only where both sides of a join come
straight from an exchange. It does not where a side was aggregated, or where
several joins share one partitioning. So rows of hot keys get a salt, the few
right rows of these keys are repeated for each salt, and both join on it too.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is hot if it also exceeds a partition's share.
HOT_ROWS = 1_000_000

SALT = "_salt"


@dataclass(frozen=True)
class Hot:
    """Hot values of one key, null among them if ``missing``, and the salts they get."""

    values: tuple
    missing: bool
    salts: int

    def holds(self, column: Column) -> Column:
        """Whether a key is hot; never null."""
        known = F.coalesce(column.isin(list(self.values)), F.lit(False)) if self.values else F.lit(False)
        return known | column.isNull() if self.missing else known


def hot_values(df: DataFrame, keys: Sequence[str]) -> dict[str, Hot]:
    """For each key that has any, its values with more rows than a shuffle partition's share."""
    return counted_hot_values(df, keys)[1]


def counted_hot_values(df: DataFrame, keys: Sequence[str]) -> tuple[int, dict[str, Hot]]:
    """The number of rows, and for each key that has any, its values with more rows than a shuffle partition's share.

    One pass counts the values of all keys, and so the rows; counts combine before their shuffle.
    Fewer such values of a key can exist than there are partitions, so the list that
    reaches the driver is bounded.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = list(dict.fromkeys(keys))
    each = F.array(*[F.struct(F.lit(i).alias("k"), F.col(c).cast("string").alias("v")) for i, c in enumerate(keys)])
    counts = df.select(F.inline(each)).groupBy("k", "v").agg(F.count("*").alias("n"))
    heavy = F.collect_list(F.when(F.col("n") > HOT_ROWS, F.struct("n", "v")))
    most = F.slice(F.sort_array(heavy, asc=False), 1, partitions)
    by_key = {r["k"]: r for r in counts.groupBy("k").agg(F.sum("n").alias("rows"), most.alias("most")).collect()}
    if not by_key:
        return 0, {}
    rows = by_key[0]["rows"]
    share = max(1, rows // partitions)
    found = {}
    for i, key in enumerate(keys):
        own = [r for r in by_key[i]["most"] if r["n"] > share]
        if own:
            values = tuple(r["v"] for r in own if r["v"] is not None)
            salts = min(partitions, -(-own[0]["n"] // share))
            found[key] = Hot(values, len(values) < len(own), salts)
    return rows, found


def salted(rows: DataFrame, key: str, hot: Hot) -> DataFrame:
    """Rows with a salt that spreads the hot keys; it follows from the row, so a retry draws the same."""
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(hot.salts)).cast("int")
    return rows.withColumn(SALT, F.when(hot.holds(F.col(key).cast("string")), spread).otherwise(0))


def repeated(right: DataFrame, key: str, hot: Hot) -> DataFrame:
    """Right rows of hot keys once for each salt, the others once. A null key matches nothing and is not repeated."""
    known = F.coalesce(F.col(key).cast("string").isin(list(hot.values)), F.lit(False)) if hot.values else F.lit(False)
    salts = F.when(known, F.sequence(F.lit(0), F.lit(hot.salts - 1))).otherwise(F.array(F.lit(0)))
    return right.withColumn(SALT, F.explode(salts))
