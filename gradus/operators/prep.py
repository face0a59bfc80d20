"""Cleaning, column statistics, imputation, normalisation and masks."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradus.operators.gram import Moments, masked_moments

CONSTANT_TERM = "constant_term"

STATS_SCHEMA = "column_name string, avg double, stddev double"

# Types that a hash aggregate keeps in place, so that no rows are sorted.
FIXED_WIDTH = (T.IntegralType, T.FractionalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def drop_duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Remove every row of a duplicated key; rows with a null key stay.

    Rows are grouped with a count and one carried row, so the copies of a hot
    key collapse before the shuffle to one row per map task. A group of one
    holds the very row it came from, hence no join back is needed. A row with a
    null key is a group of its own by its place, so the input is read once and
    many such rows spread over all tasks. Rows of numbers, flags and dates are
    grouped by hash; texts and lists, which such a table can't hold, are carried
    as one value in a sorted aggregate.
    """
    rest = [c for c in df.columns if c != key]
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    groups = df.withColumn("_alone", alone).groupBy(key, "_alone")
    if all(isinstance(df.schema[c].dataType, FIXED_WIDTH) for c in rest):
        carried = [F.first(c).alias(f"_c{k}") for k, c in enumerate(rest)]
        names = {c: F.col(f"_c{k}").alias(c) for k, c in enumerate(rest)}
    else:
        carried = [F.first(F.struct(*rest)).alias("_row")]
        names = {c: F.col("_row")[c].alias(c) for c in rest}
    single = groups.agg(F.count("*").alias("_copies"), *carried).where(F.col("_copies") == 1)
    return single.select(*[F.col(key) if c == key else names[c] for c in df.columns])


def duplicate_row_count(df: DataFrame, key: str) -> DataFrame:
    """One row: surplus copies over all keys, the null group included."""
    sizes = df.groupBy(key).agg(F.count("*").alias("n"))
    surplus = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return sizes.agg(surplus.cast("bigint").alias("duplicate_rows"))


def booleans_to_double(df: DataFrame) -> DataFrame:
    """Boolean columns as 0.0 and 1.0; other columns unchanged."""
    flags = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: F.col(c).cast("int").cast("double") for c in flags})


def feature_names(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric and boolean columns not excluded, sorted by name.

    An exclusion that names no column is reported, since it is usually a typo.
    """
    left_out = set(exclude)
    unknown = sorted(left_out - set(df.columns))
    if unknown:
        warnings.warn(f"excluded columns not in the table: {unknown}", stacklevel=2)
    usable = (T.NumericType, T.BooleanType)
    return sorted(f.name for f in df.schema if isinstance(f.dataType, usable) and f.name not in left_out)


def as_double(df: DataFrame, name: str) -> Column:
    """A column as double, by way of int for booleans."""
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return F.col(name).cast("int").cast("double")
    return F.col(name).cast("double")


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows (column_name, avg, stddev), nulls skipped.

    Tasks add up Arrow batches, so any number of columns takes one pass and a short plan,
    and what moves is three numbers per task and column.
    """
    if not cols:
        return df.sparkSession.createDataFrame([], STATS_SCHEMA)
    return FeatureStats.rows(df.sparkSession, masked_moments(df, [(c, as_double(df, c)) for c in cols], products=False))


def nonzero_variance(stats: DataFrame) -> DataFrame:
    """Columns that vary; constant, all-null and single-row columns fall out."""
    return stats.where(F.col("stddev") > 0)


@dataclass(frozen=True)
class FeatureStats:
    """Mean and deviation of the varying features, kept for later scoring."""

    names: tuple[str, ...]
    avg: tuple[float, ...]
    stddev: tuple[float, ...]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> "FeatureStats":
        if not cols:
            raise ValueError("no feature columns left after the exclusions")
        return cls.of(masked_moments(df, [(c, as_double(df, c)) for c in cols], products=False))

    @classmethod
    def of(cls, moments: Moments) -> "FeatureStats":
        """The features that vary, in name order."""
        rows = sorted(zip(moments.names, moments.mean.tolist(), moments.deviation().tolist()))
        kept = [r for r in rows if r[2] > 0]
        if not kept:
            raise ValueError("no feature column varies")
        return cls(*(tuple(k[i] for k in kept) for i in range(3)))

    @staticmethod
    def rows(spark: SparkSession, moments: Moments) -> DataFrame:
        """Rows (column_name, avg, stddev) of all columns; null where there are too few values."""
        found = zip(moments.names, moments.mean.tolist(), moments.deviation().tolist(), moments.count.tolist())
        shown = [(n, avg if count else None, sd if count > 1 else None) for n, avg, sd, count in found]
        return spark.createDataFrame(shown, STATS_SCHEMA)

    def normalised(self, df: DataFrame) -> dict[str, Column]:
        """Imputed and normalised expression of every feature."""
        out = {}
        for name, avg, sd in zip(self.names, self.avg, self.stddev):
            value = F.coalesce(as_double(df, name), F.lit(avg))
            out[name] = (value - F.lit(avg)) / F.lit(sd)
        return out

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(zip(self.names, self.avg, self.stddev)), STATS_SCHEMA)


def normalise_wide(df: DataFrame, stats: FeatureStats, keep: Sequence[str]) -> DataFrame:
    """``keep`` plus one normalised column per feature, in place; no shuffle."""
    clash = set(keep) & set(stats.names)
    if clash:
        raise ValueError(f"key or label is also a feature: {sorted(clash)}")
    return df.select(*keep, *[v.alias(n) for n, v in stats.normalised(df).items()])


def scale_with(
    df: DataFrame,
    stats: FeatureStats,
    id_col: str,
    label: str | None = None,
    constant_term: bool = False,
) -> DataFrame:
    """Feature vectors (names, raw, normalised) from stored statistics.

    Raw values keep their nulls. The constant 1 stands at its sorted place.
    """
    scaled = stats.normalised(df)
    entries = {n: (as_double(df, n), v) for n, v in scaled.items()}
    if constant_term:
        entries[CONSTANT_TERM] = (F.lit(1.0), F.lit(1.0))
    ordered = sorted(entries)
    return df.select(
        id_col,
        F.array(*[F.lit(n) for n in ordered]).alias("feat_name_vect"),
        F.array(*[entries[n][0] for n in ordered]).alias("feat_vect"),
        F.array(*[entries[n][1] for n in ordered]).alias("feat_vect_normalized"),
        *([label] if label else []),
    )


def impute_normalize(
    df: DataFrame,
    id_col: str,
    label: str | None = None,
    exclude: Iterable[str] = (),
    constant_term: bool = False,
) -> DataFrame:
    """Impute with the mean and normalise every varying feature.

    Statistics come from all rows given, unlabelled ones included. They enter
    the plan as literals, so the build itself is a projection.
    """
    cols = feature_names(df, [*exclude, id_col, *([label] if label else [])])
    return scale_with(df, FeatureStats.fit(df, cols), id_col, label, constant_term)


def apply_mask(
    df: DataFrame,
    mask: Sequence[int],
    vectors: Sequence[str] = ("feat_name_vect", "feat_vect", "feat_vect_normalized"),
) -> DataFrame:
    """Keep the vector positions whose mask entry is 1, in every vector."""
    kept = [i for i, m in enumerate(mask) if m == 1]
    return df.withColumns(
        {v: F.array(*[F.col(v)[i] for i in kept]) if kept else F.filter(v, lambda x: F.lit(False)) for v in vectors}
    )


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold no value at all."""
    seen = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[c for c, n in zip(df.columns, seen) if n > 0])


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows (column_name, mode): most frequent value, the smallest on a tie.

    Values are counted by group, so a column with many distinct values never
    sits in one aggregation buffer.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols]
    )
    counts = (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("value").alias("value")))
    return counts.groupBy("column_name").agg(best["value"].alias("mode"))


def impute_mean_or_mode(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls with the mode of text columns and the mean of numeric ones."""
    cols = list(df.columns if cols is None else cols)
    numeric = [c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)]
    text = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    fill: dict[str, Column] = {}
    if numeric:
        means = {r["column_name"]: r["avg"] for r in column_stats(df, numeric).collect()}
        fill |= {
            c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in means.items() if m is not None
        }
    if text:
        modes = {r["column_name"]: r["mode"] for r in column_modes(df, text).collect()}
        fill |= {c: F.coalesce(F.col(c), F.lit(m)) for c, m in modes.items()}
    return df.withColumns(fill) if fill else df
