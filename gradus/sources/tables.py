"""Reading, replacing and exporting tables, and the column catalog of a frame."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession


def read_tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    """Lazy parquet scans; pruning and pushdown happen when a query selects."""
    return [spark.read.parquet(f"{folder}/{name}.parquet") for name in names]


def column_catalog(
    df: DataFrame,
    exclude: Iterable[str] = (),
    types: Iterable[str] | None = None,
    by_name: bool = False,
) -> list[tuple[str, str]]:
    """(name, type) pairs of a frame in table order, or sorted by name."""
    left_out, wanted = set(exclude), None if types is None else set(types)
    found = [
        (name, kind)
        for name, kind in df.dtypes
        if name not in left_out and (wanted is None or kind in wanted)
    ]
    return sorted(found) if by_name else found


def replace_table(df: DataFrame, target: str, cluster_by: str | None = None, files: int = 200) -> None:
    """Write a result in place of whatever stood there before.

    ``target`` is a folder when it contains a slash, else a table name.
    ``cluster_by`` buckets a table, so later joins on that key need no shuffle.
    """
    writer = df.write.mode("overwrite")
    if "/" in target:
        writer.parquet(target)
    elif cluster_by:
        writer.bucketBy(files, cluster_by).sortBy(cluster_by).saveAsTable(target)
    else:
        writer.saveAsTable(target)


def store_clustered(df: DataFrame, name: str, key: str | Sequence[str], buckets: int) -> DataFrame:
    """Write a table whose rows of one key lie in one sorted file, and read it back.

    Rows move once, here. Tables stored on the same key with the same number of buckets are
    joined and grouped on it later without moving again. Rows of one key go to one task, so
    a key should not hold much more than a bucket's share; rows with a null key are one key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    placed = df.repartition(buckets, *keys)
    placed.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def buckets_of(df: DataFrame, rows_per_bucket: int = 2_000_000) -> int:
    """A number of buckets for a table, from a count of its rows."""
    return max(1, -(-df.count() // rows_per_bucket))


def export_csv(df: DataFrame, folder: str, single_file: bool = False) -> None:
    """CSV with a header. One file only on request: it means one writing task."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(folder)


def append_parts(parts: list[DataFrame]) -> DataFrame:
    """All parts as one frame, matched by column name."""
    return reduce(DataFrame.unionByName, parts)
