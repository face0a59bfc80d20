"""Tree ensembles: grid search, scoring and split importance."""

from __future__ import annotations

import hashlib
import itertools
import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from decimal import Decimal

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.functions import hash_uniform
from gradus.operators.boost import BoostSettings, bin_rows, boost
from gradus.operators.ensemble import NODE_SCHEMA, Ensemble, node_table_splits, score
from gradus.operators.evaluate import class_metrics, roc_auc_per_class, roc_curve_per_class, roc_sample
from gradus.operators.prep import as_double, feature_names
from gradus.operators.split import random_or_column_split
from gradus.session import BROADCAST_ROW_LIMIT, ROWS_PER_TASK, broadcast_if_small, hold, materialise, shared_folder, with_row
from gradus.sources.ledger import Ledger

# Column that holds the draw of the split.
DRAW = "_draw"

# Deepest tree the trainer accepts. Fixed value.
DEEPEST = 30

# Suffix of the 0/1 column that marks a missing feature value.
MISSING = "__missing"

RESULT_SCHEMA = (
    "mdl_train_ts timestamp, mdl_name string, kind string, params_indx int, params string, "
    "features array<string>, nullable array<string>, classes array<string>, class_type string, `precision` array<double>, recall array<double>, fscore array<double>, "
    "support array<bigint>, fnames array<string>, f_importances array<double>, "
    "gains array<double>, model_path string"
)


def expand_grid(params: Mapping[str, object]) -> list[dict[str, object]]:
    """Every combination of the listed values, in the key order given."""
    values = [list(v) if isinstance(v, (list, tuple)) and v else [v] for v in params.values()]
    return [dict(zip(params, combo)) for combo in itertools.product(*values)]


def class_weights(df: DataFrame, label: str, user: Mapping | DataFrame | None = None) -> DataFrame:
    """Rows (class, weight): rarer classes weigh more, weights sum to one.

    ``user`` gives the weights instead, as a mapping or, for any number of classes, as a frame
    with the columns class and weight. A class without one is an error.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("class")).agg(F.count("*").alias("n"))
    if user is not None:
        kind = df.schema[label].dataType.simpleString()
        if isinstance(user, DataFrame):
            given = user.select(F.col("class").cast(kind), F.col("weight").cast("double"))
        else:
            given = df.sparkSession.createDataFrame(
                [(c, float(w)) for c, w in user.items()], f"class {kind}, weight double"
            )
        given = broadcast_if_small(given)
        missing = [r["class"] for r in counts.join(given, "class", "left_anti").limit(20).collect()]
        if missing:
            raise ValueError(f"no weight given for the classes {missing}")
        return counts.join(given, "class").select("class", "weight")
    totals = counts.agg(F.sum("n").alias("_all"))
    rare = with_row(counts, totals).select("class", (F.col("_all") / F.col("n")).alias("_r"))
    norm = rare.agg(F.sum("_r").alias("_sum"))
    return with_row(rare, norm).select("class", (F.col("_r") / F.col("_sum")).alias("weight"))


def _forest(params: Mapping, seed: int) -> RandomForestClassifier:
    p = dict(params)
    trainer = RandomForestClassifier(
        featuresCol="_x", labelCol="_y", weightCol="_w", seed=seed,
        maxDepth=_depth(p.pop("max_depth", 5)),
        minInstancesPerNode=max(1, -(-int(p.pop("min_samples_split", 2)) // 2)),
        numTrees=int(p.pop("n_estimators", 10)),
    )
    return _refuse_unknown(trainer, p)


def _refuse_unknown(trainer, left: Mapping):
    if left:
        raise ValueError(f"unknown tree parameters: {sorted(left)}")
    return trainer


def _depth(value) -> int:
    if int(value) > DEEPEST:
        raise ValueError(f"max_depth {value}: the trainer takes {DEEPEST} at most")
    return int(value)


@dataclass(frozen=True)
class TreeModel:
    """A fitted ensemble with the features and classes it was trained on, and the splits that use each feature.

    ``fitted`` is an ``Ensemble`` (boosted trees) or a model of the forest trainer, whose missing
    values (in the features named in ``nullable``) become 0 beside an indicator.
    """

    kind: str
    features: tuple[str, ...]
    nullable: tuple[str, ...]
    classes: tuple
    fitted: object
    splits: tuple[tuple[str, float], ...] = ()

    def inputs(self) -> tuple[str, ...]:
        return (*self.features, *(f"{c}{MISSING}" for c in self.nullable))


def _vectors(df: DataFrame, features: Sequence[str], nullable: Sequence[str], keep: Sequence[Column]) -> DataFrame:
    """Feature vectors: missing values become 0 beside a 0/1 indicator.

    The trainer takes no missing values; the indicator lets a split separate
    them, which a plain fill would not.
    """
    values = [F.coalesce(as_double(df, c), F.lit(0.0)).alias(f"_f{i}") for i, c in enumerate(features)]
    flags = [F.col(c).isNull().cast("double").alias(f"_m{i}") for i, c in enumerate(nullable)]
    names = [f"_f{i}" for i in range(len(features))] + [f"_m{i}" for i in range(len(nullable))]
    wide = df.select(*keep, *values, *flags)
    return VectorAssembler(inputCols=names, outputCol="_x").transform(wide).drop(*names)


def _coded(df: DataFrame, label: str, classes: Sequence, weight_of: Mapping) -> DataFrame:
    """Adds the class index, with the classes as metadata, and the class weight."""
    kind = df.schema[label].dataType.simpleString()
    codes = df.sparkSession.createDataFrame(
        [(c, float(i), float(weight_of[c])) for i, c in enumerate(classes)], f"_class {kind}, _y double, _w double"
    )
    nominal = {"ml_attr": {"type": "nominal", "name": "_y", "vals": [str(c) for c in classes]}}
    codes = F.broadcast(codes) if len(classes) <= BROADCAST_ROW_LIMIT else codes
    joined = df.join(codes, df[label] == codes["_class"]).drop("_class")
    return joined.withMetadata("_y", nominal)


def _settled(df: DataFrame, key: str) -> DataFrame:
    """Rows in an order and in partitions that depend on the rows alone, as sampling in fits goes by both."""
    parts = max(8, -(-df.count() // ROWS_PER_TASK))
    return df.repartition(parts, F.xxhash64(key)).sortWithinPartitions(F.xxhash64(key), key)


def _class_of(index: Column, classes: Sequence) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in classes]), index.cast("int") + 1)


def split_importance(spark: SparkSession, model: TreeModel, path: str) -> DataFrame:
    """How many splits of the saved ensemble use each feature, most first."""
    if isinstance(model.fitted, Ensemble):
        return node_table_splits(spark.read.schema(NODE_SCHEMA).parquet(path))
    nodes = spark.read.parquet(f"{path}/data").select("nodeData.*")
    inputs = F.array(*[F.lit(n) for n in model.inputs()])
    used = nodes.where(F.col("leftChild") >= 0).select(
        F.element_at(inputs, F.col("split.featureIndex") + 1).alias("_input")
    )
    named = used.withColumn("feature", F.split_part("_input", F.lit(MISSING), F.lit(1)))
    return named.groupBy("feature").agg(F.count("*").alias("splits")).orderBy(F.col("splits").desc(), "feature")


def _gains(model: TreeModel) -> dict[str, float]:
    """Share of each feature in the gain, indicators counted with their feature."""
    if isinstance(model.fitted, Ensemble):
        return model.fitted.gains()
    out = dict.fromkeys(model.features, 0.0)
    for name, gain in zip(model.inputs(), model.fitted.featureImportances.toArray()):
        out[name.removesuffix(MISSING)] += float(gain)
    return out


@dataclass
class GridRun:
    """Result rows of a grid, as they are stored, and the ids tested on.

    No model stays on the driver: ``model`` reads the one of a grid point back.
    """

    results: DataFrame
    test_ids: DataFrame
    held: list[DataFrame] = field(default_factory=list)

    def model(self, index: int) -> TreeModel:
        return load_model(self.results, F.col("params_indx") == index)

    def release(self) -> None:
        for frame in self.held:
            frame.unpersist()


def _said(params: Mapping) -> str:
    """The settings of a grid point as result rows show them."""
    return ", ".join(f"{k}={v}" for k, v in params.items())


def _basis(df: DataFrame, id_col: str, label: str, *rest: object) -> str:
    """A digest of the ids and labels of the rows and of what else decides a fit beside the settings."""
    both = F.xxhash64(F.col(id_col), F.col(label).cast("string"))
    n, mixed = df.agg(F.count("*"), F.sum(both.cast("decimal(38,0)"))).first()
    return hashlib.md5(repr((n, str(mixed), *(str(r) for r in rest))).encode()).hexdigest()


def _grid_search(
    kind: str,
    df: DataFrame,
    id_col: str,
    label: str,
    exclude: Iterable[str],
    grid: Mapping,
    weights: Mapping | None,
    train_size: float,
    split_col: str | None,
    seed: int,
    parallelism: int,
    name: str,
    ledger: str | None,
) -> GridRun:
    spark = df.sparkSession
    points = list(enumerate(expand_grid(grid), start=1))
    cols = feature_names(df.drop(split_col) if split_col else df, [*exclude, id_col, label])
    # The source is read once; all that follows reads the held rows.
    side = F.col(split_col) if split_col else hash_uniform(seed, F.col(id_col)).alias(DRAW)
    rows = hold(df.select(id_col, label, *cols, side).where(F.col(label).isNotNull()))
    train, test = random_or_column_split(rows, id_col, label, train_size, split_col, seed, None if split_col else DRAW)
    by_class = train.groupBy(F.col(label).alias("_class")).agg(
        F.count("*").alias("_rows"), *[F.count(c).alias(f"_n{k}") for k, c in enumerate(cols)]
    ).collect()
    n_rows, present = sum(r["_rows"] for r in by_class), [sum(r[f"_n{k}"] for r in by_class) for k in range(len(cols))]
    nullable = [c for c, n in zip(cols, present) if 0 < n < n_rows]
    cols = [c for c, n in zip(cols, present) if n > 0]
    classes = tuple(sorted(r["_class"] for r in by_class))
    if len(classes) < 2:
        raise ValueError("a classifier needs at least two classes in the training rows")
    weight_of = {r["class"]: r["weight"] for r in class_weights(train, label, weights).collect()}

    coded = _coded(train, label, classes, weight_of)
    book = Ledger(spark, ledger or f"{shared_folder(spark)}/grids-{uuid.uuid4().hex}")
    root = f"{book.folder}/models-{uuid.uuid4().hex}"
    known = {p: book.part(name, p).first() for p in book.finished(name)}
    # A stored point counts if it is this grid's: the same settings, rows, features and classes.
    facts = (kind, cols, [str(c) for c in classes], _basis(rows, id_col, label, train_size, split_col, seed, weights))
    done = {
        index
        for index, params in points
        if index in known and (_said(params), *facts) == tuple(known[index][c] for c in ("params", "kind", "features", "classes", "basis"))
    }
    test = test.select(id_col, label, *cols)
    if kind == "gbt":
        settings = [BoostSettings.of(params, seed) for _, params in points]
        binned = bin_rows(coded, id_col, cols, F.col("_y"), F.col("_w"), len(classes))
        held = [binned.blocks, rows]

        def train_point(index: int, params: dict) -> TreeModel:
            model = boost(binned, settings[index - 1])
            model.save(spark, f"{root}/{index}")
            return TreeModel(kind, tuple(cols), tuple(nullable), classes, model)

    else:
        # Forests sample rows by partition and place, so both are fixed by the ids.
        settled = _settled(coded, id_col)
        fit_on = _vectors(settled, cols, nullable, [F.col("_y"), F.col("_w")]).persist(StorageLevel.MEMORY_AND_DISK)
        held = [fit_on, rows]

        def train_point(index: int, params: dict) -> TreeModel:
            fitted = _forest(params, seed).fit(fit_on)
            fitted.write().save(f"{root}/{index}")
            return TreeModel(kind, tuple(cols), tuple(nullable), classes, fitted)

    def fit(point: tuple[int, dict]) -> None:
        index, params = point
        model, path = train_point(index, params), f"{root}/{index}"
        said = tree_score(test, id_col, model, label)
        rated = {r["class"]: r for r in class_metrics(said, label, f"{label}_predicted").collect()}
        if kind == "gbt":
            splits = sorted(model.fitted.splits().items(), key=lambda p: (-p[1], p[0]))
        else:
            splits = [tuple(r) for r in split_importance(spark, model, path).collect()]
        gains = _gains(model)

        def metric(column: str, cast=float) -> list:
            return [cast(rated[c][column]) if c in rated else cast(0) for c in classes]

        row = (
            datetime.now(timezone.utc).replace(tzinfo=None), name, kind, index,
            _said(params), list(cols), list(nullable),
            [str(c) for c in classes], type(classes[0]).__name__,
            metric("precision"), metric("recall"), metric("fscore"), metric("support", int),
            [s[0] for s in splits], [float(s[1]) for s in splits], [gains[s[0]] for s in splits], path, facts[-1],
        )
        book.append(name, index, spark.createDataFrame([row], f"{RESULT_SCHEMA}, basis string").coalesce(1))

    left = [point for point in points if point[0] not in done]
    if left:
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(left)))) as pool:
            list(pool.map(inheritable_thread_target(spark)(fit), left))
    stored = spark.read.schema(f"{RESULT_SCHEMA}, basis string").parquet(*[book.place(name, index) for index, _ in points])
    return GridRun(stored.drop("basis"), test.select(id_col), held)


def gbt_grid_search(
    df: DataFrame, id_col: str, label: str, exclude: Iterable[str] = (), grid: Mapping | None = None,
    weights: Mapping | None = None, train_size: float = 0.8, split_col: str | None = None,
    seed: int = 42, parallelism: int = 4, name: str = "gbt", ledger: str | None = None,
) -> GridRun:
    """Boosted trees at every grid point, fitted side by side on one frame of binned rows.

    Parameters are those of ``BoostSettings``. Missing values go to the side that a split has learned.
    Each point is stored as it ends, with its model; with a ``ledger`` folder, a grid of the same
    ``name`` and rows that runs again skips the points that are stored there.
    """
    return _grid_search("gbt", df, id_col, label, exclude, grid or {}, weights, train_size, split_col, seed, parallelism, name, ledger)


def rf_grid_search(
    df: DataFrame, id_col: str, label: str, exclude: Iterable[str] = (), grid: Mapping | None = None,
    weights: Mapping | None = None, train_size: float = 0.8, split_col: str | None = None,
    seed: int = 42, parallelism: int = 4, name: str = "rf", ledger: str | None = None,
) -> GridRun:
    """Random forests at every grid point; same result rows."""
    return _grid_search("rf", df, id_col, label, exclude, grid or {}, weights, train_size, split_col, seed, parallelism, name, ledger)


# Readers of a stored class list, by the name of its Python type.
_CLASS_READERS = {"str": str, "int": int, "float": float, "bool": "True".__eq__, "Decimal": Decimal}


def load_model(results: DataFrame, where: Column) -> TreeModel:
    """The first model, by grid index, whose result row passes the filter."""
    row = results.where(where).orderBy("params_indx").first()
    if row is None:
        raise ValueError("no grid row passes the filter")
    classes = tuple(_CLASS_READERS[row["class_type"]](c) for c in row["classes"])
    splits = tuple(zip(row["fnames"], row["f_importances"]))
    if row["kind"] == "rf":
        fitted = RandomForestClassificationModel.load(row["model_path"])
    else:
        fitted = Ensemble.load(results.sparkSession, row["model_path"], row["features"], len(classes))
    return TreeModel(row["kind"], tuple(row["features"]), tuple(row["nullable"]), classes, fitted, splits)


def tree_score(df: DataFrame, id_col: str, model: TreeModel, label: str | None = None) -> DataFrame:
    """Rows (id, predicted class, class probabilities), with the label if there is one."""
    stem = label or "class_label"
    keep = [F.col(id_col), *([F.col(label)] if label else [])]
    if isinstance(model.fitted, Ensemble):
        scored, at = score(df, model.fitted, keep), F.col("_at")
    else:
        scored = model.fitted.transform(_vectors(df, model.features, model.nullable, keep))
        scored, at = scored.withColumn("_probs", vector_to_array("probability")), F.col("prediction")
    return scored.select(
        id_col,
        *([label] if label else []),
        _class_of(at, model.classes).alias(f"{stem}_predicted"),
        F.col("_probs").alias(f"{stem}_proba_predicted"),
    )


def score_metrics(
    scored: DataFrame, label: str | None, classes: Sequence, splits: Sequence[tuple[str, float]] | None = None
) -> DataFrame:
    """Per-class metrics and ROC area of a scored table; 'NA' rows without a label.

    ``splits`` are a model's pairs of feature and number of splits. With them every
    row also lists the features and their importances, most important first.
    """
    spark = scored.sparkSession
    if label is None:
        rated = spark.createDataFrame([("NA",) * 6], "class string, precision string, recall string, fscore string, support string, roc_auc string")
    else:
        metrics = class_metrics(scored, label, f"{label}_predicted")
        areas = roc_auc_per_class(scored, label, f"{label}_proba_predicted", classes)
        rated = metrics.join(F.broadcast(areas), "class", "left").orderBy("class")
    if splits is None:
        return rated
    names, counts = [f for f, _ in splits], [float(n) for _, n in splits]
    return rated.withColumns(
        {
            "fnames": F.array(*[F.lit(f) for f in names]).cast("array<string>"),
            "f_importances": F.array(*[F.lit(n) for n in counts]).cast("array<double>"),
        }
    )


@dataclass(frozen=True)
class TreeScore:
    """Scored rows, metrics with importances, and the sampled curve of every class."""

    rows: DataFrame
    metrics: DataFrame
    curves: DataFrame | None


def tree_score_all(
    df: DataFrame, id_col: str, model: TreeModel, label: str | None = None, points: int = 1000
) -> TreeScore:
    """Score a table and, where it has a label, rate the scores.

    Without a label the metrics are one 'NA' row beside the importances and there
    are no curves. Curves hold ``points`` rows a class.
    """
    rows = tree_score(df, id_col, model, label)
    if label is None:
        return TreeScore(rows, score_metrics(rows, None, model.classes, model.splits), None)
    rows = materialise(rows)
    curves = roc_curve_per_class(rows, label, f"{label}_proba_predicted", model.classes)
    return TreeScore(
        rows,
        score_metrics(rows, label, model.classes, model.splits),
        roc_sample(curves, points, within=["class"]),
    )
