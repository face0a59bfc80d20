"""Feature-table assembly: many keyed tables joined onto a base table."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import groupby

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradus.functions import year_digits
from gradus.operators.skew import SALT, Hot, counted_hot_values, hot_values, repeated, salted
from gradus.session import BROADCAST_ROW_LIMIT

# Keys a feature table may share with the base, in the order they are tried.
JOIN_KEYS = ("person_uid", "academic_period", "course_identification")


# Bytes, by a guess from rows and types, that the joins of one task sort. Adaptive
# execution merges partitions by their compressed bytes, a small part of that.
TASK_BYTES = 128 << 20

# Joins whose sorts one task holds at the same time.
JOINS_PER_STAGE = 4

# Key of a year-level table, as written for ``base_key_expr``.
YEAR_KEYS = ("person_uid", "year:academic_period")


@dataclass(frozen=True)
class FeatureRules:
    """Which columns of a feature table are features, and how tables join."""

    exclude: tuple[str, ...] = ()
    exclude_regex: tuple[str, ...] = ()
    not_features: tuple[str, ...] = ()
    year_level: tuple[str, ...] = ()
    join_keys: tuple[str, ...] = JOIN_KEYS
    custom_joins: Mapping[str, Sequence[str]] = field(default_factory=dict)


def select_feature_columns(
    columns: Iterable[str], exclude: Iterable[str] = (), exclude_regex: Iterable[str] = ()
) -> list[str]:
    """Columns that neither match a listed name nor any unanchored pattern."""
    names, patterns = set(exclude), [re.compile(p) for p in exclude_regex]
    return [c for c in columns if c not in names and not any(p.search(c) for p in patterns)]


def detect_join_keys(columns: Iterable[str], keys: Sequence[str] = JOIN_KEYS) -> list[str]:
    """The join keys a feature table has."""
    present = set(columns)
    found = [k for k in keys if k in present]
    if not found:
        raise ValueError(f"feature table has none of the join keys {list(keys)}")
    return found


def select_sources(groups: Mapping[str, Sequence[str]], asked: Iterable[str]) -> list[str]:
    """Tables of the asked source groups, in the order asked; unknown names are ignored."""
    return [table for source in asked for table in groups.get(source, ())]


def skip_non_feature_tables(tables: Iterable[str], not_features: Iterable[str]) -> list[str]:
    skipped = set(not_features)
    return [t for t in tables if t not in skipped]


def _row_bytes(df: DataFrame) -> int:
    """Bytes of a row while it is sorted, guessed by type."""
    plain = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return 48 + sum(8 if isinstance(f.dataType, plain) else 32 for f in df.schema)


def _row_counts(frames: Sequence[DataFrame]) -> list[int]:
    """Rows of each frame, counted in one job."""
    parts = [f.select(F.lit(i).alias("i")) for i, f in enumerate(frames)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    found = {r["i"]: r["n"] for r in every.groupBy("i").agg(F.count("*").alias("n")).collect()}
    return [found.get(i, 0) for i in range(len(frames))]


def _left_join(
    base: DataFrame, features: DataFrame, on: Mapping[str, Column], chosen: list[str], hot: Hot | None = None,
    parts: int = 0,
) -> DataFrame:
    """Left join of the chosen columns; ``on`` maps a base expression to each right key.

    With hot values of the first key the base must be salted for it. With ``parts`` the base is
    partitioned on the first key into that many, and the features follow.
    """
    clash = [c for c in chosen if c in base.columns]
    if clash:
        raise ValueError(f"columns already present in the assembled table: {clash}")
    right = features.select(
        *[expr.alias(f"_k{i}") for i, expr in enumerate(on.values())], *chosen
    )
    if hot:
        right = repeated(right, "_k0", hot).withColumnRenamed(SALT, "_right_salt")
    if parts:
        right = right.repartition(parts, *(["_k0", "_right_salt"] if hot else ["_k0"]))
    condition = [base_key_expr(base, k) == right[f"_k{i}"] for i, k in enumerate(on)]
    if hot:
        condition.append(base[SALT] == right["_right_salt"])
    joined = base.join(right, condition, "left")
    return joined.drop(*[f"_k{i}" for i in range(len(on))], "_right_salt")


def base_key_expr(base: DataFrame, key: str) -> Column:
    """A base key, where ``year:col`` stands for the year digits of ``col``."""
    if key.startswith("year:"):
        return year_digits(base[key[5:]])
    return base[key]


def _spread(base: DataFrame, leading: str, join) -> DataFrame:
    """One join whose hot leading keys are looked for and salted."""
    hot = hot_values(base, [leading]).get(leading)
    return join(salted(base, leading, hot), hot).drop(SALT) if hot else join(base, None)


def join_on_keys(base: DataFrame, features: DataFrame, keys: Sequence[str], chosen: list[str]) -> DataFrame:
    """Left join on equal keys; duplicated feature keys multiply rows."""
    return _spread(base, keys[0], lambda rows, hot: _join_on_keys(rows, features, keys, chosen, hot))


def _join_on_keys(base, features, keys, chosen, hot, parts=0) -> DataFrame:
    return _left_join(base, features, {k: F.col(k) for k in keys}, chosen, hot, parts)


def join_year_level(base: DataFrame, features: DataFrame, chosen: list[str] | None = None) -> DataFrame:
    """Left join of a year-level table on person and the year digits of the term."""
    return _spread(base, "person_uid", lambda rows, hot: _join_year_level(rows, features, chosen, hot))


def _join_year_level(base, features, chosen, hot, parts=0) -> DataFrame:
    if chosen is None:
        chosen = [c for c in features.columns if c not in ("person_uid", "aid_year")]
    on = {"person_uid": F.col("person_uid"), "year:academic_period": year_digits(F.col("aid_year"))}
    return _left_join(base, features, on, chosen, hot, parts)


def _join_group(group: list, rows: DataFrame, hot: Hot | None, parts: int = 0) -> DataFrame:
    """Left joins of the tables of one leading key.

    A task holds the sorts of all joins that share a partitioning, so after every few joins
    the rows move again; with ``parts`` into that many partitions. As all joins then find the rows
    on the leading key, the longest key goes first, and shorter ones use the order it leaves.
    """
    leading = group[0][0][0]
    if parts:
        group = sorted(group, key=lambda p: (-len(p[0]), p[0]))
    for i, (keys, table, chosen) in enumerate(group):
        if i % JOINS_PER_STAGE == 0 and (i or parts):
            rows = rows.repartition(*([parts] if parts else []), leading, *([SALT] if hot else []))
        if keys == YEAR_KEYS:
            rows = _join_year_level(rows, table, chosen, hot, parts)
        else:
            rows = _join_on_keys(rows, table, keys, chosen, hot, parts)
    return rows


def _partitions(base: DataFrame, rows: int, others: Sequence[int], planned: Sequence[tuple]) -> dict[str, int]:
    """For each leading key with a large feature table, partitions that bound what the joins of a task sort.

    ``rows`` are those of the base, ``others`` those of the planned tables.
    """
    width = _row_bytes(base) + 8 * sum(len(chosen) for _, _, chosen in planned)
    cores = base.sparkSession.sparkContext.defaultParallelism
    found = {}
    for leading in {keys[0] for keys, _, _ in planned}:
        own = [(n, _row_bytes(table.select(*chosen)) + 32 * len(keys)) for n, (keys, table, chosen) in zip(others, planned) if keys[0] == leading]
        held = 2 * rows * width + sum(sorted((n * size for n, size in own), reverse=True)[:JOINS_PER_STAGE])
        needed = -(-held // TASK_BYTES)
        if needed > 1 and max(n for n, _ in own) > BROADCAST_ROW_LIMIT:
            found[leading] = max(needed, cores)
    return found


def assemble_features(
    base: DataFrame, feature_tables: Mapping[str, DataFrame], rules: FeatureRules = FeatureRules()
) -> DataFrame:
    """Base columns plus the selected columns of every feature table.

    Left joins onto one base commute, so they run sorted by their keys: the
    tables of one leading key, shortest key first, follow each other on the
    partitioning of the first. Hot leading keys, missing ones among them, are counted
    in one pass over the base, which counts its rows as well, and salted, so the base is read once
    whatever is hot. Feature tables are counted at the same time; where one is large, the rows move into
    as many partitions as keep a task's sorts small. Columns come out in the order of the tables.
    """
    planned = []
    for name in skip_non_feature_tables(feature_tables, rules.not_features):
        table = feature_tables[name]
        chosen = select_feature_columns(table.columns, rules.exclude, rules.exclude_regex)
        if name in rules.year_level:
            keys = YEAR_KEYS
        else:
            keys = tuple(rules.custom_joins.get(name) or detect_join_keys(table.columns, rules.join_keys))
        planned.append((keys, table, chosen))
    if not planned:
        return base
    ordered = sorted(planned, key=lambda p: (p[0][0], len(p[0]), p[0]))
    spark, assembled = base.sparkSession, base
    with ThreadPoolExecutor(max_workers=1) as pool:
        others = pool.submit(inheritable_thread_target(spark)(_row_counts), [table for _, table, _ in ordered])
        n, hot = counted_hot_values(base, [p[0][0] for p in ordered])
        parts = _partitions(base, n, others.result(), ordered)
    for leading, group in groupby(ordered, key=lambda p: p[0][0]):
        own = hot.get(leading)
        rows = salted(assembled, leading, own) if own else assembled
        assembled = _join_group(list(group), rows, own, parts.get(leading, 0)).drop(SALT)
    return assembled.select(*base.columns, *[c for _, _, chosen in planned for c in chosen])


def assemble_stored(base: DataFrame, feature_tables: Sequence[DataFrame], key: str = "person_uid") -> DataFrame:
    """Base columns plus those of every feature table, for tables stored clustered on ``key``.

    Tables written by ``store_clustered`` on the key, with equal numbers of buckets, are joined
    where they lie: no table moves, however many there are. Feature tables have one row for a
    key and share no column but the key. Null keys find no features.
    """
    names = [c for t in feature_tables for c in t.columns if c != key]
    clash = sorted({c for c in names if names.count(c) > 1 or c in base.columns})
    if clash:
        raise ValueError(f"columns of several tables: {clash}")
    rows = base
    for table in feature_tables:
        # No table is sent to all tasks, as the rows of a key already lie side by side.
        rows = rows.hint("merge").join(table, key, "left")
    return rows.select(*base.columns, *names)


# Filters that define an admitted applicant, apart from the terms asked for.
# Fixed values.
ADMITTED = {
    "latest_decision": ("AA", "AN"),
    "campus": ("PWL",),
    "admissions_population": ("B", "SB"),
    "student_level": ("U", "UG"),
    "curriculum_priority_number": (1,),
}


def admitted_applications(applications: DataFrame, terms: Sequence[str], fixed: Mapping = ADMITTED) -> DataFrame:
    """Applications that pass the fixed filters in the given terms."""
    keep = F.col("academic_period").isin(*terms)
    for column, allowed in fixed.items():
        keep = keep & F.col(column).isin(*allowed)
    return applications.where(keep)


def admitted_cohort(applications: DataFrame, terms: Sequence[str], fixed: Mapping = ADMITTED) -> DataFrame:
    """Distinct persons with an admitted application."""
    return admitted_applications(applications, terms, fixed).select("person_uid").distinct()


def term_split(
    df: DataFrame, cutoff: int, score_terms: Sequence[str], term: str = "academic_period"
) -> tuple[DataFrame, DataFrame]:
    """Training rows before the cut-off term and rows of the terms to score."""
    return df.where(F.col(term).cast("int") < cutoff), df.where(F.col(term).isin(*score_terms))


def grade_subset(df: DataFrame, terms: Sequence[str], min_size: int = 60, size: str = "course_size") -> DataFrame:
    """Rows of large courses in the given terms."""
    return df.where((F.col(size) >= min_size) & F.col("academic_period").isin(*terms))


def label_subset(df: DataFrame, label: str) -> DataFrame:
    """Rows whose label is known."""
    return df.where(F.col(label).isNotNull())
