"""Points in intervals of any length, as an equi join on nested buckets.

An interval goes to the level whose buckets are at least as long as it is, twice as long
from level to level, so it touches two buckets at most however long it is. A point looks
into one bucket of each level that any interval is on, and the ends are compared there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradus.operators.ranking import running_totals
from gradus.session import broadcast_if_small, materialise

# The gap to a point's predecessor is looked up among this many places in time order.
CHUNK_BITS = 20

_EXACT = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _place(df: DataFrame, column: str) -> Column:
    """A whole number in the order of the column: microseconds of times, days of dates."""
    kind = df.schema[column].dataType
    if not isinstance(kind, _EXACT):
        raise ValueError(f"{column} must be a whole number, a date or a time, not {kind.simpleString()}")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    return F.unix_date(column).cast("long") if isinstance(kind, T.DateType) else F.col(column).cast("long")


def interval_join(
    points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, on: Sequence[str] = (),
    how: str = "inner", closed: bool = True,
) -> DataFrame:
    """Rows of points beside each interval that holds them, with the columns of both.

    ``start`` belongs to an interval, ``end`` only if it is ``closed``. ``on`` names columns that
    must be equal too; they come once. ``how`` is ``inner``, or ``left`` to keep points that no
    interval holds. Times, dates and whole numbers can be looked up, all three of one kind.
    Points and intervals with a null there, and intervals that end before they start, meet
    nothing. Apart from ``on`` the frames may share no column names.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    on = list(on)
    shared = (set(points.columns) & set(intervals.columns)) - set(on)
    if shared:
        raise ValueError(f"columns of both frames: {sorted(shared)}")
    kinds = {type(df.schema[c].dataType) for df, c in ((points, at), (intervals, start), (intervals, end))}
    if len(kinds) > 1 and not all(issubclass(k, T.IntegralType) for k in kinds):
        raise ValueError(f"{at}, {start} and {end} are of different kinds")

    low, high = _place(intervals, start), _place(intervals, end)
    valid = (high >= low) if closed else (high > low)
    # The number of bits of the length: buckets of that level are longer than it.
    level = F.length(F.bin(high - low)).cast("int")
    first, last = F.expr("shiftright(_low, _level)"), F.expr("shiftright(_high, _level)")
    spans = intervals.withColumns({"_low": low, "_high": high}).where(valid).withColumn("_level", level)
    spans = spans.withColumn("_bucket", F.explode(F.array_distinct(F.array(first, last))))
    levels = sorted(r[0] for r in spans.select("_level").distinct().collect())  # 64 at most

    asking = points
    if how == "left":
        # Rows get a number in a written copy, so that those without an interval are known.
        asking = materialise(points.withColumn("_row", F.monotonically_increasing_id()))
    places = F.array(*[F.struct(F.lit(v).alias("_l"), F.expr(f"shiftright(_at, {v})").alias("_b")) for v in levels])
    if not levels:
        places = F.array().cast("array<struct<_l: int, _b: bigint>>")
    asked = asking.withColumn("_at", _place(points, at)).where("_at IS NOT NULL").withColumn("_p", F.explode(places))
    offered = spans.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = (F.col("_p._l") == F.col("_level")) & (F.col("_p._b") == F.col("_bucket"))
    for c in on:
        same = same & (asked[c] == offered[f"_on_{c}"])
    inside = (F.col("_low") <= F.col("_at")) & ((F.col("_at") <= F.col("_high")) if closed else (F.col("_at") < F.col("_high")))
    found = asked.join(broadcast_if_small(offered), same & inside)
    rest = [c for c in intervals.columns if c not in on]
    if how == "inner":
        return found.select(*points.columns, *rest)
    met = found.select("_row", F.struct(*rest).alias("_found"))
    joined = asking.join(met, "_row", "left")
    return joined.select(*points.columns, *[F.col("_found")[c].alias(c) for c in rest])


def _merged(spans: DataFrame, group: str) -> DataFrame:
    """Overlapping or touching spans of a group as one, with the number that is left of the group."""
    ordered = Window.partitionBy(group).orderBy("_low", "_high")
    reach = F.max("_high").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    begins = spans.withColumn("_new", F.coalesce(F.col("_low") > reach, F.lit(True)).cast("int"))
    numbered = begins.withColumn("_run", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy(group, "_run").agg(F.min("_low").alias("_low"), F.max("_high").alias("_high"))
    return runs.withColumn("_parts", F.count("*").over(Window.partitionBy(group))).drop("_run")


def _links(seen: DataFrame) -> DataFrame:
    """Places ``_r`` of a ``_who`` one after the other, as pairs ``_p`` and ``_r``.

    They are taken within chunks of places, then from chunk to chunk, so that a frequent one does not go to one task.
    """
    chunked = seen.select("_who", "_r", F.shiftright("_r", CHUNK_BITS).alias("_chunk"))
    before = F.lag("_r").over(Window.partitionBy("_who", "_chunk").orderBy("_r"))
    within = chunked.select(before.alias("_p"), "_r")
    ends = chunked.groupBy("_who", "_chunk").agg(F.min("_r").alias("_r"), F.max("_r").alias("_last"))
    across = ends.select(F.lag("_last").over(Window.partitionBy("_who").orderBy("_chunk")).alias("_p"), "_r")
    return within.unionByName(across).where("_p IS NOT NULL")


def interval_counts(
    points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, group: str, distinct: str,
    closed: bool = True,
) -> DataFrame:
    """For each ``group`` of intervals, points inside (``n``, once for each interval) and distinct values of theirs (``users``).

    As ``interval_join``, grouped and counted, but no pairs are listed, so the work grows with the
    frames, not with what the intervals hold. ``n`` is a difference of running counts. The points with a
    value stand at places 0, 1, 2 ... in time; an interval from place s to e has e - s of them, less those whose
    predecessor of the same value is inside too: pairs (p, r) with s <= p and r < e. These are counted by running
    totals along r in the nodes of a binary tree over p; a pair is in a node of each level at most, and an interval
    asks one. Groups whose intervals leave gaps are joined, since a value may come back after a gap.
    """
    low, high = _place(intervals, start), _place(intervals, end)
    valid = (high >= low) if closed else (high > low)
    spans = intervals.where(valid).select(F.col(group), low.alias("_low"), high.alias("_high"))
    spans = spans.groupBy(group, "_low", "_high").agg(F.count("*").alias("_times"))
    merged = materialise(_merged(spans, group))
    seen = points.select(F.col(distinct).alias("_who"), _place(points, at).alias("_t")).where("_t IS NOT NULL")
    seen = seen.groupBy("_who", "_t").agg(F.count("*").alias("_rows"))

    # Starts and open ends stand before the points of their time, closed ends behind them.
    asked = spans.withColumn("_parts", F.lit(None).cast("long")).unionByName(merged.where("_parts = 1").withColumn("_times", F.lit(0).cast("long")))
    edges = F.array(
        F.struct(F.col("_low").alias("_t"), F.lit(0).alias("_side"), F.lit(False).alias("_end")),
        F.struct(F.col("_high").alias("_t"), F.lit(2 if closed else 0).alias("_side"), F.lit(True).alias("_end")),
    )
    line = seen.withColumn("_side", F.lit(1)).unionByName(asked.select("*", F.inline(edges)), allowMissingColumns=True)
    totals = {"_n": F.coalesce("_rows", F.lit(0)), "_r": ((F.col("_side") == 1) & F.col("_who").isNotNull()).cast("long")}
    line = running_totals(line, totals, [F.col("_t"), F.col("_side"), F.col("_who")])
    ends = [
        F.max(F.when(F.col("_end") == last, F.col(c))).alias(name)
        for c, last, name in (("_n", False, "_n0"), ("_n", True, "_n1"), ("_r", False, "_s"), ("_r", True, "_e"))
    ]
    found = materialise(line.where("_side <> 1").groupBy(group, "_low", "_high", "_times", "_parts").agg(*ends))
    links = _links(line.where("_side = 1 AND _who IS NOT NULL").select("_who", (F.col("_r") - 1).alias("_r")))

    whole = found.where("_parts = 1")
    bits = max(1, int(whole.agg(F.max("_e")).first()[0] or 0).bit_length())
    # Node k of level v has the number 2^(bits - v) + k; the pair with p stands at p + 1, so that more than s is asked.
    levels = F.sequence(F.lit(0), F.lit(bits - 1))
    up = F.expr(f"shiftleft(1L, {bits} - _v)")
    pairs = links.where(F.col("_p") + 1 < (1 << bits)).withColumn("_p", F.col("_p") + 1)
    pairs = pairs.withColumn("_v", F.explode(levels)).where("shiftright(_p, _v) & 1 = 1")
    pairs = pairs.select((up + F.expr("shiftright(_p, _v)")).alias("_node"), "_r", F.lit(1).alias("_side"))
    asks = whole.select(group, "_s", "_e", F.explode(levels).alias("_v")).where("shiftright(_s, _v) & 1 = 0")
    asks = asks.where("shiftleft(shiftright(_s, _v) + 1, _v) < _e")
    asks = asks.select(group, (up + F.expr("shiftright(_s, _v) + 1")).alias("_node"), F.col("_e").alias("_r"), F.lit(0).alias("_side"))
    nested = running_totals(
        asks.unionByName(pairs, allowMissingColumns=True), {"_in": F.col("_side")}, [F.col("_r"), F.col("_side")], within=["_node"]
    )

    gapped = merged.where("_parts > 1").select(group, "_low", "_high")
    again = interval_join(seen.where("_who IS NOT NULL").select("_who", "_t"), gapped, "_t", "_low", "_high", closed=closed)
    parts = [
        found.where("_parts IS NULL").select(group, (F.col("_times") * (F.col("_n1") - F.col("_n0"))).alias("n"), F.lit(0).alias("users")),
        whole.select(group, F.lit(0).alias("n"), (F.col("_e") - F.col("_s")).alias("users")),
        nested.where("_side = 0").select(group, F.lit(0).alias("n"), (-F.col("_in")).alias("users")),
        again.groupBy(group).agg(F.count_distinct("_who").alias("users")).select(group, F.lit(0).alias("n"), "users"),
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy(group).agg(F.sum("n").alias("n"), F.sum("users").alias("users")).where("n > 0")
