"""Matching of treated rows to controls.

Nearest matches are exact without pairing every treated with every control.
Both arms are reduced to distinct points, control space is cut into boxes from a
bounded sample, and a treated point meets the controls of its own box first, then
those of the nearest boxes that could still hold a nearer one, then the rest of these.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradus.operators.gram import gram_matrix
from gradus.operators.prep import column_stats
from gradus.operators.ranking import global_row_number, running_totals
from gradus.session import BROADCAST_ROW_LIMIT, broadcast_if_small, materialise, with_row

# Control points a box should hold, and the boxes the cuts are planned for. Larger
# boxes are searched in parts, so the number of boxes bounds no group.
POINTS_PER_BOX = 2_000
MOST_CUTS = 16_384
CONTROLS_PER_GROUP = 50_000

# Control points the driver sees in order to place the cuts.
SAMPLE_PER_BOX = 8

# Treated points that search one box in one group.
TREATED_PER_GROUP = 20_000

# Boxes that a point asks before its bound is drawn in for the last time.
NEXT_BOXES = 8

# Share of a distance that turning the columns may cost; points within it are compared by the columns themselves.
SLACK = 1e-6


def match_nulls(df: DataFrame, omit: bool = True, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null, or fill numeric columns with their mean as doubles."""
    if omit:
        return df.dropna(subset=cols)
    wanted = set(df.columns if cols is None else cols)
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name in wanted]
    means = {r["column_name"]: r["avg"] for r in column_stats(df, numeric).collect()}
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in means.items() if m is not None}
    )


def _sortable(df: DataFrame, column: str) -> tuple[str, Column]:
    """Which of the long, double and text slots a column's values sort in, and the value."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return "l", F.col(column).cast("bigint")
    if isinstance(kind, T.NumericType):
        return "d", F.col(column).cast("double")
    return "t", F.col(column).cast("string")


def factor_codes(df: DataFrame, cols: Sequence[str], treatment: str | None = None) -> DataFrame:
    """Replace columns by codes 1, 2, 3 … of their sorted values; the treatment by 0 and 1.

    The distinct values of all columns are found in one scan and numbered in one
    distributed sort. A column's codes are broadcast only if they were counted few.
    """
    every = [*cols, *([treatment] if treatment else [])]
    slots = {c: _sortable(df, c) for c in every}
    empty = {"l": F.lit(None).cast("bigint"), "d": F.lit(None).cast("double"), "t": F.lit(None).cast("string")}
    entries = [
        F.struct(F.lit(c).alias("name"), *[(value if s == slot else none).alias(s) for s, none in empty.items()])
        for c, (slot, value) in slots.items()
    ]
    values = df.select(F.inline(F.array(*entries))).where("l is not null or d is not null or t is not null")
    ranked = global_row_number(values.distinct(), [F.col(c) for c in ("name", "l", "d", "t")], "_rank")
    found = ranked.groupBy("name").agg(F.min("_rank").alias("first"), F.count("*").alias("n")).collect()
    spans = {r["name"]: (r["first"], r["n"]) for r in found}
    coded = df
    for c, (slot, _) in slots.items():
        first, size = spans.get(c, (1, 0))
        start = 0 if c == treatment else 1
        codes = ranked.where(F.col("name") == c).select(
            F.col(slot).alias("_value"), (F.col("_rank") - first + start).cast("int").alias("_code")
        )
        codes = F.broadcast(codes) if size <= BROADCAST_ROW_LIMIT else codes
        joined = coded.join(codes, _sortable(df, c)[1] == F.col("_value"), "left")
        coded = joined.select(*[F.col("_code").alias(c) if n == c else F.col(n) for n in df.columns])
    return coded


@dataclass(frozen=True)
class Boxes:
    """Axis-parallel cuts of space: a tree kept in arrays, and its leaf boxes.

    A cut has its value and two children; a child below zero is a box (its complement). ``low``
    and ``high`` bound the boxes, ``node_low`` and ``node_high`` the cuts.
    """

    axis: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    high: np.ndarray
    node_low: np.ndarray
    node_high: np.ndarray

    @classmethod
    def around(cls, points: np.ndarray, wanted: int) -> "Boxes":
        """Cut at medians until there are ``wanted`` boxes or points run out."""
        k = points.shape[1]
        axis, cut, boxes, nodes = [], [], [], []
        todo = [(points, np.full(k, -np.inf), np.full(k, np.inf), 1, None)]
        while todo:
            inside, low, high, share, parent = todo.pop()
            place = None
            if share < wanted and len(inside) > 1:
                place = _median_cut(inside)
            if place is None:
                node = ~len(boxes)
                boxes.append((low, high))
            else:
                at, value = place
                node = len(axis)
                axis.append(at)
                nodes.append((low, high))
                cut.append([value, 0, 0])
                below = inside[:, at] <= value
                upper_low, lower_high = low.copy(), high.copy()
                lower_high[at] = upper_low[at] = value
                todo.append((inside[below], low, lower_high, share * 2, (node, 1)))
                todo.append((inside[~below], upper_low, high, share * 2, (node, 2)))
            if parent:
                cut[parent[0]][parent[1]] = node
        return cls(
            np.array(axis, dtype=int),
            np.array(cut, dtype=float).reshape(-1, 3),
            np.array([b[0] for b in boxes]),
            np.array([b[1] for b in boxes]),
            np.array([n[0] for n in nodes]).reshape(-1, k),
            np.array([n[1] for n in nodes]).reshape(-1, k),
        )

    def locate(self, points: np.ndarray) -> np.ndarray:
        """Box number of each point."""
        node = np.zeros(len(points), dtype=int) if len(self.axis) else np.full(len(points), -1)
        walking = np.flatnonzero(node >= 0)
        while len(walking):
            at = node[walking]
            above = points[walking, self.axis[at]] > self.cut[at, 0]
            node[walking] = self.cut[at, np.where(above, 2, 1)].astype(int)
            walking = walking[node[walking] >= 0]
        return ~node

    def distances(self, points: np.ndarray, boxes: np.ndarray) -> np.ndarray:
        """Least distance of each point to the box beside it."""
        outside = np.maximum(np.maximum(self.low[boxes] - points, points - self.high[boxes]), 0.0)
        return np.sqrt((outside**2).sum(axis=1))

    def within(self, points: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs of a point and a box that begins within the point's reach, with that distance.

        All points descend together; a pair of point and cut goes on only to children in reach.
        """
        who, node = np.arange(len(points)), np.full(len(points), 0 if len(self.axis) else -1)
        found = []
        while who.size:
            ends = node < 0
            if ends.any():
                boxes = ~node[ends]
                found.append((who[ends], boxes, self.distances(points[who[ends]], boxes)))
                who, node = who[~ends], node[~ends]
            if not who.size:
                break
            who, node = np.repeat(who, 2), self.cut[node, 1:].astype(int).reshape(-1)
            inner, place = node >= 0, np.where(node >= 0, node, ~node)
            low, high = (
                np.where(inner[:, None], of_node[place * inner], of_box[place * ~inner]) if len(of_node) else of_box[place]
                for of_node, of_box in ((self.node_low, self.low), (self.node_high, self.high))
            )
            outside = np.maximum(np.maximum(low - points[who], points[who] - high), 0.0)
            near = np.sqrt((outside**2).sum(axis=1)) <= reach[who]
            who, node = who[near], node[near]
        if not found:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        return tuple(np.concatenate(part) for part in zip(*found))


def _median_cut(points: np.ndarray) -> tuple[int, float] | None:
    """Cut near the median of the widest axis that has two values."""
    for at in np.argsort(-np.ptp(points, axis=0)):
        values = np.unique(points[:, at])
        if len(values) > 1:
            middle = np.searchsorted(values, np.median(points[:, at]))
            return int(at), float(values[min(max(middle, 1), len(values) - 1) - 1])
    return None


def _whitening(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """Matrix that turns Mahalanobis distance into plain distance."""
    gram = gram_matrix(df, cols)
    covariance = gram.cross / max(gram.n - 1, 1)
    values, vectors = np.linalg.eigh(covariance)
    usable = values > 1e-12 * max(values.max(), 1e-300)
    return (vectors[:, usable] / np.sqrt(values[usable])).T


def _significant(values: np.ndarray) -> np.ndarray:
    """Values at nine significant digits, so that equal distances compare equal."""
    size = np.where(values > 0, values, 1.0)
    scale = 10.0 ** (8 - np.floor(np.log10(size)))
    return np.where(values > 0, np.round(values * scale) / scale, 0.0)


def _nearest(
    treated: pd.DataFrame, controls: pd.DataFrame, zs: list[str], xs: list[str], metric: np.ndarray
) -> pd.DataFrame:
    """Nearest control of each treated point among those given, with the squared distance.

    Plain distances of the turned columns find the controls that come close; among these the
    form over the columns' own differences decides, which is the same for equal differences.
    """
    c, t = controls[zs].to_numpy(), treated[zs].to_numpy()
    cx, tx = controls[xs].to_numpy(), treated[xs].to_numpy()
    order = controls["matched_id"].rank(method="first").to_numpy()
    ids, chosen, reach = controls["matched_id"].to_numpy(), [], []
    step = max(1, 2_000_000 // max(len(c), 1))
    for start in range(0, len(t), step):
        part = t[start : start + step]
        square = np.zeros((len(part), len(c)))
        for j in range(c.shape[1]):
            square += (part[:, j, None] - c[None, :, j]) ** 2
        least = square.min(axis=1) if c.shape[1] else np.zeros(len(part))
        who, which = np.nonzero(square <= (least * (1 + SLACK) + _floor(tx[start : start + step], metric))[:, None])
        exact = _form(tx[start + who] - cx[which], metric)
        best = np.lexsort((order[which], exact, who))
        first = best[np.unique(who[best], return_index=True)[1]]
        chosen.append(ids[which[first]])
        reach.append(exact[first])
    out = treated[xs].copy()
    out["square"], out["matched_id"] = np.concatenate(reach), np.concatenate(chosen)
    return out


def _floor(points: np.ndarray, metric: np.ndarray) -> np.ndarray:
    """Squares that are rounding beside the size of the points."""
    return 1e-24 * (points * points) @ np.abs(np.diag(metric))


def _form(gap: np.ndarray, metric: np.ndarray) -> np.ndarray:
    """The quadratic form of each row of differences, term by term; a row and its opposite give the same number."""
    total = np.zeros(len(gap))
    for i in range(len(metric)):
        total += metric[i, i] * (gap[:, i] * gap[:, i])
        for j in range(i):
            total += 2 * metric[i, j] * (gap[:, i] * gap[:, j])
    return np.maximum(total, 0.0)


def match_nearest(df: DataFrame, id_col: str, treatment: str, match_on: Sequence[str]) -> DataFrame:
    """Rows (id, matched_id, distance): the nearest control of every treated row.

    Distance is Mahalanobis over the numeric ``match_on`` columns, with
    replacement, rounded to nine digits in the result only: the control with the least
    squared distance in doubles wins wherever it was found, and only equal squares go to the
    smaller id. Rows with a null there have no match.
    """
    xs = list(match_on)
    rows = df.select(id_col, F.col(treatment).cast("int").alias("_arm"), *[F.col(x).cast("double") for x in xs])
    rows = materialise(rows.dropna(subset=["_arm", *xs]))  # narrow, and read several times
    white = _whitening(rows, xs)
    zs, metric = [f"z{i}" for i in range(len(white))], white.T @ white

    def place(points: DataFrame) -> DataFrame:
        z = [sum((F.col(x) * F.lit(float(w)) for x, w in zip(xs, row)), F.lit(0.0)) for row in white]
        return points.select("*", *[e.alias(n) for e, n in zip(z, zs)])

    controls = rows.where(F.col("_arm") == 0).groupBy(*xs).agg(F.min(id_col).alias("matched_id"))
    controls = materialise(place(controls))
    treated = place(rows.where(F.col("_arm") == 1).select(*xs).distinct())

    wanted = min(MOST_CUTS, max(1, -(-controls.count() // POINTS_PER_BOX)))
    sample = controls.select(*zs).orderBy(F.xxhash64(*zs), *zs).limit(wanted * SAMPLE_PER_BOX).toPandas()
    id_type = df.schema[id_col].dataType.simpleString()
    if sample.empty:
        empty = f"{id_col} {id_type}, matched_id {id_type}, distance double"
        return df.sparkSession.createDataFrame([], empty)
    boxes = Boxes.around(sample.to_numpy(), wanted)

    @F.pandas_udf("int")
    def box_of(point: pd.DataFrame) -> pd.Series:
        return pd.Series(boxes.locate(point.to_numpy(dtype=float)).astype("int32"))

    point_schema = ", ".join(f"`{x}` double" for x in xs)
    found_schema = f"{point_schema}, square double, matched_id {id_type}"
    best = F.min(F.struct("square", "matched_id"))

    def least(found: DataFrame) -> DataFrame:
        return found.groupBy(*xs).agg(best.alias("_m")).select(*xs, "_m.square", "_m.matched_id")

    controls = controls.withColumn("box", box_of(F.struct(*zs)))
    spark = df.sparkSession

    held = materialise(
        controls.groupBy("box").agg(F.ceil(F.count("*") / CONTROLS_PER_GROUP).cast("int").alias("_shares"))
    )

    def search(asking: DataFrame) -> DataFrame:
        """Nearest control of each point in the boxes it asks; crowded boxes are searched in several groups."""
        asking = materialise(asking)
        crowd = asking.groupBy("box").agg(F.ceil(F.count("*") / TREATED_PER_GROUP).cast("int").alias("_groups"))
        groups = materialise(crowd.join(held, "box").withColumnRenamed("box", "_box"))
        groups = F.broadcast(groups)  # at most one row per box
        asked = (
            asking.join(groups, asking["box"] == groups["_box"])
            .withColumn("part", F.pmod(F.xxhash64(*xs), F.col("_groups")).cast("int"))
            .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
        )
        offered = (
            controls.join(groups, controls["box"] == groups["_box"])
            .withColumn("share", F.pmod(F.xxhash64("matched_id"), F.col("_shares")).cast("int"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)))
        )

        def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return pd.DataFrame(columns=[*xs, "square", "matched_id"])
            return _nearest(left, right, zs, xs, metric)

        found = (
            asked.select("box", "part", "share", *xs, *zs)
            .groupBy("box", "part", "share")
            .cogroup(offered.select("box", "part", "share", "matched_id", *xs, *zs).groupBy("box", "part", "share"))
            .applyInPandas(meet, found_schema)
        )
        return least(found)

    z_schema = ", ".join(f"{z} double" for z in zs)

    def ask(known: DataFrame, first: int, last: int | None) -> DataFrame:
        """The boxes in reach of the best found so far, from the ``first``-th on by distance; the own box is no part of them."""

        def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                points = batch[zs].to_numpy()
                reach = np.sqrt(batch["square"].to_numpy() * (1 + SLACK) + _floor(batch[xs].to_numpy(), metric))
                home = boxes.locate(points)
                who, box, far = boxes.within(points, reach)
                away = box != home[who]
                who, box, far = who[away], box[away], far[away]
                order = np.lexsort((box, far, who))
                who, box = who[order], box[order]
                rank = np.arange(len(who)) - np.searchsorted(who, who)
                some = (rank >= first) & (rank < (len(boxes.low) if last is None else last))
                if some.any():
                    again = batch.iloc[who[some]][[*xs, *zs]].copy()
                    again["box"] = box[some].astype("int32")
                    yield again

        return place(known).mapInPandas(others, f"{point_schema}, {z_schema}, box int")

    found = materialise(search(treated.withColumn("box", box_of(F.struct(*zs)))))
    if wanted > 1:
        # The order of a point's boxes does not change as its bound shrinks, so the second step goes on where the first ended.
        found = materialise(least(found.unionByName(search(ask(found, 0, NEXT_BOXES)))))
        if wanted > NEXT_BOXES + 1:
            found = materialise(least(found.unionByName(search(ask(found, NEXT_BOXES, None)))))

    @F.pandas_udf("double")
    def shown(square: pd.Series) -> pd.Series:
        return pd.Series(_significant(np.sqrt(square.to_numpy(dtype=float))))

    matched = found.select(*xs, "matched_id", shown("square").alias("distance"))
    return (
        rows.where(F.col("_arm") == 1)
        .join(broadcast_if_small(matched), xs)
        .select(id_col, "matched_id", "distance")
    )


def cell_imbalance(df: DataFrame, treatment: str, match_on: Sequence[str]) -> DataFrame:
    """One row: half the summed difference of the arms' shares over the cells."""
    treated, control = F.col(treatment) == 1, F.col(treatment) == 0
    cells = df.groupBy(*match_on).agg(
        F.count(F.when(treated, 1)).alias("t"), F.count(F.when(control, 1)).alias("c")
    )
    totals = cells.agg(F.sum("t").alias("all_t"), F.sum("c").alias("all_c"))
    gap = F.abs(F.col("t") / F.col("all_t") - F.col("c") / F.col("all_c"))
    return with_row(cells, totals).agg((F.sum(gap) / 2).alias("imbalance"))


def matching_frontier(df: DataFrame, id_col: str, treatment: str, match_on: Sequence[str]) -> DataFrame:
    """Rows (step, pruned id, controls_left, imbalance): which control goes next, and how unlike the arms are then.

    A cell's excess is what its controls are above their fixed ratio to its treated rows. Each step
    prunes a control of the cell with the greatest excess left, in the order of cells and then of
    ids where excesses are equal, until no cell has any; treated rows all stay. Step 0 prunes
    nothing. The imbalance is half the summed difference of the arms' shares over the cells.

    Nothing runs step by step: a control's excess is its cell's less the controls before it, so
    one distributed sort gives the order. The imbalance is the sum of the positive differences;
    a cell with an excess is positive all along, and another one turns positive at a step that
    its sizes tell, so running totals over the steps give every value.
    Rows with a null are left out. Without treated rows or controls there are no rows.
    """
    cells = list(match_on)
    rows = df.select(id_col, F.col(treatment).cast("int").alias("_arm"), *cells).dropna()
    sizes = rows.groupBy(*cells).agg(
        F.count(F.when(F.col("_arm") == 1, 1)).alias("_t"), F.count(F.when(F.col("_arm") == 0, 1)).alias("_k")
    )
    sizes = materialise(sizes)
    all_t, all_k = sizes.agg(F.sum("_t"), F.sum("_k")).first()
    id_type = df.schema[id_col].dataType.simpleString()
    if not all_t or not all_k:
        return df.sparkSession.createDataFrame([], f"step long, {id_col} {id_type}, controls_left long, imbalance double")
    wide = "decimal(38,0)"
    t, k = F.lit(all_t).cast("decimal(19,0)"), F.lit(all_k).cast("decimal(19,0)")
    # Excess in parts of a control, as many as there are treated rows, so that it is a whole number.
    excess = (F.col("_k").cast("decimal(19,0)") * t - F.col("_t").cast("decimal(19,0)") * k).cast(wide)
    sizes = sizes.withColumn("_excess", excess)

    over = sizes.where("_excess > 0").select(*cells, "_excess")
    controls = rows.where(F.col("_arm") == 0).select(id_col, *cells)
    numbered = running_totals(controls, {"_number": F.lit(1)}, [F.col(id_col)], within=cells)
    joined = numbered.join(broadcast_if_small(over), cells)
    level = F.col("_excess") - ((F.col("_number") - 1).cast("decimal(19,0)") * t).cast(wide)
    pruned = joined.withColumn("_level", level).where("_level > 0")
    order = [F.col("_level").desc(), *[F.col(c) for c in cells], F.col(id_col)]
    pruned = global_row_number(pruned.select("_level", *cells, id_col), order, "step").select("step", id_col)

    none = F.lit(None).cast(id_type).alias(id_col)
    steps = pruned.unionByName(sizes.limit(1).select(F.lit(0).cast("long").alias("step"), none))
    steps = steps.select(F.col("step").cast("long"), id_col, F.lit(0).cast("long").alias("_t"), F.lit(0).cast("long").alias("_k"), F.lit(1).alias("_last"))
    # A cell without excess turns positive after so many steps; before step 0 if it has its share.
    turns = F.when(F.col("_excess") >= 0, -1).otherwise(F.floor(-F.col("_excess").cast("double") / F.col("_t")).cast("long") + 1)
    events = sizes.select(turns.cast("long").alias("step"), none, "_t", "_k", F.lit(0).alias("_last"))
    summed = running_totals(
        steps.unionByName(events), {"_pos_t": F.col("_t"), "_pos_k": F.col("_k")}, [F.col("step"), F.col("_last")]
    )
    left = F.lit(all_k) - F.col("step")
    value = (F.col("_pos_k") - F.col("step")) / left - F.col("_pos_t") / F.lit(all_t)
    value = F.when(left > 0, F.greatest(value, F.lit(0.0))).otherwise(F.lit(1.0))
    return summed.where("_last = 1").select("step", id_col, left.cast("long").alias("controls_left"), value.alias("imbalance"))


def match_cells(df: DataFrame, id_col: str, treatment: str, match_on: Sequence[str]) -> DataFrame:
    """Rows (id, matched_id): arms paired inside a cell in id order.

    Rows are numbered across partitions, so a cell with a third of all rows is
    numbered by many tasks; pairs then meet on (cell, number), which is unique.
    """
    cells = list(match_on)
    rows = df.select(id_col, F.col(treatment).alias("_arm"), *cells).dropna(subset=["_arm", *cells])
    numbered = running_totals(rows, {"_number": F.lit(1)}, [F.col(id_col)], within=[*cells, "_arm"])
    treated = numbered.where(F.col("_arm") == 1).select(id_col, *cells, "_number")
    control = numbered.where(F.col("_arm") == 0).select(F.col(id_col).alias("matched_id"), *cells, "_number")
    return treated.join(control, [*cells, "_number"]).select(id_col, "matched_id")


def matching(
    df: DataFrame,
    id_col: str,
    outcome: str,
    treatment: str,
    match_vars: Sequence[str] | None = None,
    distance: str = "L2",
    omit_nulls: bool = True,
) -> DataFrame:
    """Prepare, code and match in one call; rows (id, matched_id).

    Without ``match_vars`` everything but id, outcome and treatment is matched on.
    """
    fixed = {id_col, outcome, treatment}
    match_on = list(match_vars) if match_vars else [c for c in df.columns if c not in fixed]
    used = [outcome, treatment, *match_on]
    ready = match_nulls(df.select(id_col, *used), omit_nulls, None if omit_nulls else used)
    coded = factor_codes(ready, match_on, treatment)
    if distance == "L1":
        return match_cells(coded, id_col, treatment, match_on)
    if distance == "L2":
        return match_nearest(coded, id_col, treatment, match_on).select(id_col, "matched_id")
    raise ValueError("distance must be 'L1' or 'L2'")
