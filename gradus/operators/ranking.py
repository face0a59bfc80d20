"""Exact ranks and running totals that never gather a group into one task.

A window ordered over a whole table, or over a group that holds a third of it,
runs in one task. Here the rows are range partitioned on (group, order), written
once to the shared folder, and numbered inside their partitions. What crosses
partition borders is one small total per partition, so every offset table has at
most a few rows per partition whatever the data holds.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegralType

from gradus.session import materialise

# monotonically_increasing_id puts the partition above bit 33, the row below.
ROW_BITS = 33



def range_sorted(df: DataFrame, order_by: Sequence[Column]) -> DataFrame:
    """Rows range partitioned and sorted, with a position column ``_at``.

    The written copy fixes the partition borders: a range partitioner samples,
    so a second evaluation might draw them elsewhere. No number of partitions is
    asked for, so neighbours are merged where the data is small.
    """
    placed = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    return materialise(placed.withColumn("_at", F.monotonically_increasing_id()))


def _part() -> Column:
    return F.shiftright(F.col("_at"), ROW_BITS)


def global_row_number(df: DataFrame, order_by: Sequence[Column], name: str = "row_number") -> DataFrame:
    """Add 1, 2, 3 … in ``order_by``, which should be a total order."""
    placed = range_sorted(df, order_by).withColumn("_part", _part())
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + local + 1)
        .drop("_part", "_at", "_start")
    )


def running_totals(
    df: DataFrame,
    totals: dict[str, Column],
    order_by: Sequence[Column],
    within: Sequence[str] = (),
) -> DataFrame:
    """Add running sums of ``totals`` in ``order_by``, restarting in each group.

    Every row gets the sum up to and including itself. With equal order values
    the order among them is open, so pass a total order.
    """
    within = list(within)
    groups = [F.col(c).asc_nulls_first() for c in within]
    valued = df.withColumns({f"_l_{n}": _summable(df, v) for n, v in totals.items()})
    local = _cumulated(valued, [f"_l_{n}" for n in totals], [*groups, *order_by], within)
    placed = local.withColumn("_part", _part())
    local = placed

    pieces = placed.groupBy("_part", *within).agg(
        *[F.max_by(f"_l_{n}", "_at").alias(f"_p_{n}") for n in totals]
    )
    if within:
        # Only the last group of a partition can go on in the next one.
        key = F.struct(*[F.struct(F.col(c).isNotNull().alias("has"), F.col(c).alias("v")) for c in within])
        last = pieces.groupBy("_part").agg(F.max(key).alias("_key")).select("_key").distinct()
        pieces = pieces.withColumn("_key", key).join(F.broadcast(last), "_key", "left_semi")
    else:
        pieces = pieces.withColumn("_key", F.lit(0))

    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select(
        F.col("_part").alias("_o_part"),
        *[F.col(c).alias(f"_o_{c}") for c in within],
        *[F.sum(f"_p_{n}").over(earlier).alias(f"_c_{n}") for n in totals],
    )
    same = local["_part"] == carried["_o_part"]
    for c in within:
        same = same & local[c].eqNullSafe(carried[f"_o_{c}"])
    joined = local.join(F.broadcast(carried), same, "left")
    summed = {
        n: F.col(f"_l_{n}") + F.coalesce(F.col(f"_c_{n}"), F.lit(0).cast(joined.schema[f"_l_{n}"].dataType))
        for n in totals
    }
    return joined.select(*df.columns, *[v.alias(n) for n, v in summed.items()])


def _summable(df: DataFrame, value: Column) -> Column:
    """A value as long, or as double if it is no whole number."""
    kind = df.select(value.alias("v")).schema["v"].dataType
    return value.cast("bigint" if isinstance(kind, (IntegralType, BooleanType)) else "double")


def _cumulated(df: DataFrame, columns: Sequence[str], order_by: Sequence[Column], within: Sequence[str]) -> DataFrame:
    """Rows range partitioned, sorted and written, with running sums of ``columns`` inside each partition.

    Sums are taken while the sorted rows pass by and restart where a group
    begins; a null counts as nothing. So the rows move once.
    """
    placed = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    group = F.to_json(F.struct(*within)) if within else F.lit("")
    placed = placed.withColumn("_group", group)
    names = placed.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carry = None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column(names.index("_group"))
            changed = np.ones(batch.num_rows, bool)
            changed[1:] = pc.not_equal(group.slice(1), group.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            first = group[0].as_py()
            starts = np.flatnonzero(changed)
            of = np.cumsum(changed) - 1
            arrays = list(batch.columns)
            for name in columns:
                at = names.index(name)
                values = pc.fill_null(arrays[at], 0).to_numpy(zero_copy_only=False).copy()
                if first == last:
                    values[0] += carry[name]
                total = np.cumsum(values)
                before = np.concatenate(([0], total[starts[1:] - 1])).astype(values.dtype)
                total = total - before[of]
                carry[name] = total[-1]
                arrays[at] = pa.array(total, arrays[at].type)
            last = group[batch.num_rows - 1].as_py()
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    summed = placed.mapInArrow(run, placed.schema).drop("_group")
    return materialise(summed.withColumn("_at", F.monotonically_increasing_id()))

