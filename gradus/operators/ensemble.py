"""Tree ensembles as a table of nodes, and scoring by walking their arrays.

A node row tells its tree, the class the tree adds to, feature and cut (values below go
left), the side of missing values, its children and what a leaf adds. A later session
needs the table alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.operators.prep import as_double

# Nodes that travel to a task at once. A larger ensemble scores in several steps.
PART_NODES = 1 << 20

NODE_SCHEMA = (
    "tree int, class_at int, node int, feature string, cut double, missing_left boolean, left int, right int, "
    "value double, gain double, cover double"
)


@dataclass(frozen=True)
class Tree:
    """One tree: arrays by node, the root first. ``feature`` is -1 in leaves; ``left`` and ``right`` are nodes."""

    class_at: int
    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row of a matrix, whose missing values are not numbers."""
        at = np.zeros(len(x), np.int32)
        moving = np.flatnonzero(self.feature[at] >= 0)
        while moving.size:
            node = at[moving]
            value = x[moving, self.feature[node]]
            left = np.where(np.isnan(value), self.missing_left[node], value < self.cut[node])
            at[moving] = np.where(left, self.left[node], self.right[node])
            moving = moving[self.feature[at[moving]] >= 0]
        return at


def probabilities(margins: np.ndarray) -> np.ndarray:
    """Class probabilities: logistic of a single margin, else their softmax."""
    with np.errstate(over="ignore"):
        if margins.shape[1] == 1:
            high = 1.0 / (1.0 + np.exp(-margins[:, 0]))
            return np.column_stack([1.0 - high, high])
        raised = np.exp(margins - margins.max(axis=1, keepdims=True))
        return raised / raised.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class Ensemble:
    """Trees over named features. Two classes share one margin, more have one each."""

    features: tuple[str, ...]
    n_classes: int
    trees: tuple[Tree, ...]

    @property
    def margins(self) -> int:
        return 1 if self.n_classes == 2 else self.n_classes

    def rows(self, spark: SparkSession) -> DataFrame:
        """The node table."""
        columns: dict[str, list] = {f.split()[0]: [] for f in NODE_SCHEMA.split(", ")}
        for number, tree in enumerate(self.trees):
            n = len(tree.feature)
            columns["tree"] += [number] * n
            columns["class_at"] += [tree.class_at] * n
            columns["node"] += range(n)
            columns["feature"] += [self.features[f] if f >= 0 else None for f in tree.feature.tolist()]
            inner = tree.feature >= 0
            for name in ("cut", "missing_left", "left", "right", "gain"):
                columns[name] += [v if i else None for v, i in zip(getattr(tree, name).tolist(), inner.tolist())]
            columns["value"] += tree.value.tolist()
            columns["cover"] += tree.cover.tolist()
        kinds = {"int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
        arrays = {c.split()[0]: pa.array(columns[c.split()[0]], kinds[c.split()[1]]) for c in NODE_SCHEMA.split(", ")}
        return spark.createDataFrame(pa.table(arrays), NODE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.rows(spark).coalesce(1).write.parquet(path)

    @classmethod
    def from_rows(cls, nodes: DataFrame, features: Sequence[str], n_classes: int) -> Ensemble:
        """The ensemble of a node table, whose nodes may be numbered in any way with root 0.

        An inner node without a side for missing values sends them left.
        """
        place = {f: k for k, f in enumerate(features)}
        found = nodes.orderBy("tree", "node").toArrow().to_pydict()
        starts = [0, *(k for k in range(1, len(found["tree"])) if found["tree"][k] != found["tree"][k - 1])]
        trees = []
        for a, b in zip(starts, [*starts[1:], len(found["tree"])]) if found["tree"] else ():
            own = {name: values[a:b] for name, values in found.items()}
            number = {n: k for k, n in enumerate(own["node"])}
            if own["node"][0] != 0:
                raise ValueError(f"tree {own['tree'][0]} has no node 0")

            def numbers(name: str, missing: float, own=own) -> np.ndarray:
                return np.array([missing if v is None else v for v in own[name]], float)

            trees.append(
                Tree(
                    int(own["class_at"][0]),
                    np.array([-1 if f is None else place[f] for f in own["feature"]], np.int32),
                    numbers("cut", np.nan),
                    np.array([v is None or v for v in own["missing_left"]]),
                    np.array([number.get(v, 0) for v in own["left"]], np.int32),
                    np.array([number.get(v, 0) for v in own["right"]], np.int32),
                    numbers("value", 0.0),
                    numbers("gain", 0.0),
                    numbers("cover", 0.0),
                )
            )
        return cls(tuple(features), n_classes, tuple(trees))

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: Sequence[str], n_classes: int) -> Ensemble:
        return cls.from_rows(spark.read.schema(NODE_SCHEMA).parquet(path), features, n_classes)

    def parts(self, most: int = PART_NODES) -> list[tuple[Tree, ...]]:
        """Trees in runs of at most ``most`` nodes (and one tree)."""
        out: list[list[Tree]] = [[]]
        size = 0
        for tree in self.trees:
            if out[-1] and size + len(tree.feature) > most:
                out.append([])
                size = 0
            out[-1].append(tree)
            size += len(tree.feature)
        return [tuple(p) for p in out]

    def splits(self) -> dict[str, int]:
        """How many splits use each feature that any split uses."""
        counts = np.zeros(len(self.features), int)
        for tree in self.trees:
            np.add.at(counts, tree.feature[tree.feature >= 0], 1)
        return {f: int(c) for f, c in zip(self.features, counts) if c}

    def gains(self) -> dict[str, float]:
        """Share of each feature in the gain of all splits."""
        total = np.zeros(len(self.features))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
        whole = total.sum()
        return {f: float(t / whole) if whole else 0.0 for f, t in zip(self.features, total)}


def node_table_splits(nodes: DataFrame) -> DataFrame:
    """How many splits of a node table use each feature, most first."""
    used = nodes.where("feature IS NOT NULL").groupBy("feature").agg(F.count("*").alias("splits"))
    return used.orderBy(F.col("splits").desc(), "feature")


def score(df: DataFrame, model: Ensemble, keep: Sequence[Column], part_nodes: int = PART_NODES) -> DataFrame:
    """The kept columns, ``_at`` (likeliest class, the first of equal ones) and ``_probs`` of every row.

    Null and not-a-number features are missing values. Trees travel with the tasks, ``part_nodes``
    nodes at a time; margins are carried from step to step.
    """
    m, k = len(model.features), model.margins
    frame = df.select(
        F.struct(*keep).alias("kept"),
        F.array(*[F.coalesce(as_double(df, f), F.lit(float("nan"))) for f in model.features]).alias("x"),
        F.array().cast("array<double>").alias("margin"),
    )
    kept = frame.schema["kept"].dataType.simpleString()
    parts = model.parts(part_nodes)

    def matrix(column: pa.Array, width: int) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)

    def listed(values: np.ndarray) -> pa.Array:
        offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))

    for step, part in enumerate(parts):
        last = step == len(parts) - 1

        def run(batches: Iterator[pa.RecordBatch], part=part, first=step == 0, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = matrix(batch.column(1), m) if m else np.zeros((batch.num_rows, 0))
                total = np.zeros((len(x), k)) if first else matrix(batch.column(2), k).copy()
                for tree in part:
                    total[:, tree.class_at] += tree.value[tree.leaves(x)]
                if last:
                    found = probabilities(total)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), pa.array(found.argmax(axis=1), pa.int32()), listed(found)], ["kept", "_at", "_probs"]
                    )
                else:
                    yield pa.RecordBatch.from_arrays([*batch.columns[:2], listed(total)], ["kept", "x", "margin"])

        schema = f"kept {kept}, _at int, _probs array<double>" if last else f"kept {kept}, x array<double>, margin array<double>"
        frame = frame.mapInArrow(run, schema)
    return frame.select("kept.*", "_at", "_probs")


TREE_FIELDS = tuple(f.name for f in fields(Tree))
