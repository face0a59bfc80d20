"""Reproducible train and test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.functions import hash_uniform
from gradus.operators.ranking import global_row_number, running_totals
from gradus.session import broadcast_if_small, materialise


# Parts of the draws that are counted to find where a test side ends.
DRAW_PARTS = 1 << 12


def fold_draw(key: str, folds: int, sample: int, seed: int) -> Column:
    """Fold a row falls in when the given sample is drawn."""
    return F.floor(hash_uniform(f"{seed}-{sample}", F.col(key)) * folds)


def random_split(
    df: DataFrame, key: str, label: str, train_fraction: float, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a keyed hash; rows without a label are dropped."""
    drawn = df.where(F.col(label).isNotNull()).withColumn("_u", hash_uniform(seed, F.col(key)))
    train = drawn.where(F.col("_u") <= train_fraction).drop("_u")
    return train, drawn.where(F.col("_u") > train_fraction).drop("_u")


def leave_fold_samples(df: DataFrame, key: str, folds: int, seed: int = 42) -> list[DataFrame]:
    """Samples that each leave out about one fold; every sample draws anew."""
    return [df.where(fold_draw(key, folds, i, seed) != i - 1) for i in range(1, folds + 1)]


def group_cumulative_split(
    df: DataFrame,
    group: str,
    unit: str,
    train_fraction: float = 0.8,
    name: str = "train_set",
) -> DataFrame:
    """Mark whole units as training until a group has its share of rows.

    Units are taken in order inside their group. Row counts per unit are made
    before any ordering, and the running count crosses partitions, so neither a
    hot unit nor a group of many units is gathered in one task.
    """
    units = df.groupBy(group, unit).agg(F.count("*").alias("_rows"))
    cumulated = running_totals(
        units, {"_cume": F.col("_rows")}, [F.col(unit).asc_nulls_last()], within=[group]
    )
    sizes = cumulated.groupBy(group).agg(F.max("_cume").alias("_total"))
    marked = (
        cumulated.where(F.col(unit).isNotNull() & F.col(group).isNotNull())
        .join(broadcast_if_small(sizes), group)
        .select(
            F.col(group).alias("_g"),
            F.col(unit).alias("_u"),
            (F.col("_cume") < F.col("_total") * F.lit(train_fraction)).cast("int").alias("_mark"),
        )
    )
    marked = broadcast_if_small(materialise(marked))
    joined = df.join(marked, (df[group] == marked["_g"]) & (df[unit] == marked["_u"]), "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce("_mark", F.lit(0)).alias(name))


def split_balance(df: DataFrame, by: list[str], name: str = "train_set") -> DataFrame:
    """Training and test rows per group."""
    return df.groupBy(*by).agg(
        F.count(F.when(F.col(name) == 1, 1)).alias("train_rows"),
        F.count(F.when(F.col(name) == 0, 1)).alias("test_rows"),
    )


def random_or_column_split(
    df: DataFrame,
    key: str,
    label: str,
    train_size: float = 0.8,
    split_col: str | None = None,
    seed: int = 42,
    draw: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split by a 1/0 column, or at random when no column is named.

    ``draw`` names a column that already has the rows' hashed draws; it is not part of the result.

    The random test set holds at most a fifth of the rows, so that runs with
    different training sizes are tested on equally many. The split column is
    not part of the result.
    """
    labelled = df.where(F.col(label).isNotNull())
    if split_col:
        train = labelled.where(F.col(split_col) == 1).drop(split_col)
        return train, labelled.where(F.col(split_col) == 0).drop(split_col)
    if draw:
        drawn = labelled.withColumnRenamed(draw, "_u")
    else:
        drawn = labelled.withColumn("_u", hash_uniform(seed, F.col(key)))
    train = drawn.where(F.col("_u") <= train_size).drop("_u")
    rest = drawn.where(F.col("_u") > train_size)
    # A histogram of the draws tells which of them is the last to be tested on; only those around it are ranked.
    part = F.floor(F.col("_u") * DRAW_PARTS).cast("long")
    sizes = drawn.select(F.when(F.col("_u") <= train_size, -1).otherwise(part).alias("p")).groupBy("p").count()
    counted = {r["p"]: r["count"] for r in sizes.collect()}
    cap = int(sum(counted.values()) * min(1 - train_size, 0.2))
    below = 0
    for last in sorted(p for p in counted if p >= 0):
        if below + counted[last] > cap:
            break
        below += counted[last]
    else:
        return train, rest.drop("_u")
    ranked = global_row_number(rest.where(part == last), [F.col("_u"), F.col(key)], "_rank")
    tested = rest.where(part < last).unionByName(ranked.where(F.col("_rank") <= cap - below).drop("_rank"))
    return train, tested.drop("_u")
