"""Queries of the boosted trees and of node tables, with SQL that works the same trees out."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradus.operators import boost, ensemble, trees
from gradus.queries.evaluation import _auc_sql
from gradus.queries.models import TESTED_SQL, tree_items
from gradus.queries.preparation import UNIFORM_SQL
from gradus.queries.registry import query, round_sql, rounded, table

# ------------------------------------------------------- splits of a first tree

ITEMS_SQL = """
    items AS (
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_suppkey, l_partkey) AS pk1, l_quantity::DOUBLE AS quantity,
               CASE WHEN l_linenumber <> 1 THEN l_discount::DOUBLE END AS discount, l_tax::DOUBLE AS tax,
               CAST(l_extendedprice + 1500 * l_quantity + 400000 * l_discount > 120000 AS INTEGER) AS large
        FROM lineitem)"""


def _long_sql(source: str, features: tuple[str, ...]) -> str:
    """A row for each feature: its name, value, gradient and hessian."""
    return " UNION ALL ".join(f"SELECT class_at, '{f}' AS feature, {f} AS x, g, h FROM {source}" for f in features)


def _splits_sql(source: str, features: tuple[str, ...], least: float, rate: float) -> str:
    """The best split of every feature and margin: all cuts, missing values on either side."""
    worth = "({0}g * {0}g) / ({0}h + 1)"
    return f"""
    long AS ({_long_sql(source, features)}),
    total AS (SELECT class_at, feature, sum(g) AS g, sum(h) AS h FROM long GROUP BY ALL),
    absent AS (SELECT class_at, feature, coalesce(sum(g) FILTER (x IS NULL), 0) AS g, coalesce(sum(h) FILTER (x IS NULL), 0) AS h FROM long GROUP BY ALL),
    sums AS (SELECT class_at, feature, x, sum(g) AS g, sum(h) AS h FROM long WHERE x IS NOT NULL GROUP BY ALL),
    below AS (
        SELECT class_at, feature, coalesce(lead(x) OVER w, 'inf'::DOUBLE) AS cut, sum(g) OVER w AS g, sum(h) OVER w AS h
        FROM sums WINDOW w AS (PARTITION BY class_at, feature ORDER BY x)),
    sides AS (
        SELECT b.class_at, b.feature, b.cut, missing_left, b.g + if(missing_left, a.g, 0) AS lg, b.h + if(missing_left, a.h, 0) AS lh, t.g AS tg, t.h AS th
        FROM below b JOIN absent a USING (class_at, feature) JOIN total t USING (class_at, feature), (VALUES (true), (false)) s(missing_left)),
    halves AS (SELECT *, tg - lg AS rg, th - lh AS rh FROM sides),
    gains AS (
        SELECT *, {worth.format("l")} + {worth.format("r")} - {worth.format("t")} AS gain,
               -{rate} * lg / (lh + 1) AS left_value, -{rate} * rg / (rh + 1) AS right_value
        FROM halves WHERE lh >= {least} AND rh >= {least} AND lh > 0 AND rh > 1e-9),
    best AS (
        SELECT * FROM gains WHERE gain > 1e-6
        QUALIFY row_number() OVER (PARTITION BY class_at, feature ORDER BY round(gain, 7) DESC, cut, missing_left DESC) = 1)"""


FOUND = "class_at int, feature string, cut double, missing_left boolean, gain double, left_value double, right_value double"
FOUND_SQL = f"""SELECT class_at, feature, cut, missing_left, {round_sql("gain", 4)} AS gain,
    {round_sql("left_value")} AS left_value, {round_sql("right_value")} AS right_value FROM best"""


def _found(spark, binned):
    splits = boost.first_splits(binned, boost.BoostSettings(min_child_weight=10))
    binned.release()
    found = spark.createDataFrame([tuple(s[c.split()[0]] for c in FOUND.split(", ")) for s in splits], FOUND)
    return found.withColumns(
        {"gain": rounded("gain", 4), "left_value": rounded("left_value"), "right_value": rounded("right_value")}
    )


@query(
    f"""
    WITH {ITEMS_SQL},
    grads AS (SELECT 0 AS class_at, *, 0.5::DOUBLE - large AS g, 0.25::DOUBLE AS h FROM items),
    {_splits_sql("grads", ("discount", "quantity", "tax"), 10, 0.1)}
    {FOUND_SQL}
    """
)
def boost_first_round(spark, d):
    """What the first tree chooses from: the best split of every feature, with the side of missing values."""
    items = tree_items(spark, d)
    return _found(spark, boost.bin_rows(items, "pk1", ["discount", "quantity", "tax"], F.col("large"), F.lit(1.0), 2))


STATUS_SQL = """
    orders_of AS (
        SELECT position(o_orderstatus IN 'FOP') - 1 AS y, month(o_orderdate)::DOUBLE AS month,
               CASE WHEN o_orderpriority <> '3-MEDIUM' THEN substr(o_orderpriority, 1, 1)::DOUBLE END AS priority,
               year(o_orderdate)::DOUBLE AS year
        FROM orders)"""


@query(
    f"""
    WITH {STATUS_SQL},
    grads AS (
        SELECT c AS class_at, month, priority, year, 1 / 3.0::DOUBLE - CAST(y = c AS INTEGER) AS g, 4 / 9.0::DOUBLE AS h
        FROM orders_of, (VALUES (0), (1), (2)) v(c) WHERE y >= 0),
    {_splits_sql("grads", ("month", "priority", "year"), 10, 0.1)}
    {FOUND_SQL}
    """
)
def boost_first_round_classes(spark, d):
    """Three classes at once: softmax gradients, one tree for each from the same sums."""
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        (F.expr("position(o_orderstatus IN 'FOP')") - 1).alias("y"),
        F.month("o_orderdate").alias("month"),
        F.when(F.col("o_orderpriority") != "3-MEDIUM", F.substring("o_orderpriority", 1, 1).cast("double")).alias("priority"),
        F.year("o_orderdate").alias("year"),
    )
    return _found(spark, boost.bin_rows(orders, "o_orderkey", ["month", "priority", "year"], F.col("y"), F.lit(1.0), 3))


# ------------------------------------------- a whole grid of one tree of one split

STUMP = {"learning_rate": [0.3], "max_depth": [1], "min_child_weight": [5], "n_estimators": [1]}

STUMP_SQL = f"""
    {ITEMS_SQL}, {TESTED_SQL.format(uniform=UNIFORM_SQL.format(seed=42, key="pk1"), source="items", key="pk1")},
    train AS (SELECT * FROM drawn WHERE u <= 0.8),
    rarity AS (SELECT large, (SELECT count(*) FROM train) / count(*)::DOUBLE AS r FROM train GROUP BY 1),
    grads AS (
        SELECT 0 AS class_at, quantity, discount, tax, (0.5::DOUBLE - large) * (r / (SELECT sum(r) FROM rarity)) AS g,
               0.25::DOUBLE * (r / (SELECT sum(r) FROM rarity)) AS h
        FROM train JOIN rarity USING (large)),
    {_splits_sql("grads", ("discount", "quantity", "tax"), 5, 0.3)},
    stump AS (SELECT * FROM best ORDER BY round(gain, 7) DESC, feature LIMIT 1)"""

_MARGIN = """CASE WHEN x IS NULL THEN if(missing_left, left_value, right_value) WHEN x < cut THEN left_value ELSE right_value END"""


def _stump_scored_sql(source: str) -> str:
    return f"""
    scored AS (
        SELECT pk1, large, CAST(p > 1 - p AS INTEGER) AS large_predicted, p
        FROM (SELECT *, 1 / (1 + exp(-({_MARGIN}))) AS p
              FROM (SELECT i.*, s.*, CASE s.feature WHEN 'discount' THEN discount WHEN 'tax' THEN tax ELSE quantity END AS x
                    FROM {source} i, stump s)))"""


def _rates_sql() -> str:
    """Precision, recall, F and support of both classes in ``scored``."""
    return f"""
    rates AS (
        SELECT c AS class, {round_sql("if(said = 0, 0, hit / said::DOUBLE)")} AS precision,
               {round_sql("if(support = 0, 0, hit / support::DOUBLE)")} AS recall,
               {round_sql("if(said + support = 0 OR hit = 0, 0, 2 * hit / (said + support)::DOUBLE)")} AS fscore, support
        FROM (SELECT c, count(*) FILTER (large = c AND large_predicted = c) AS hit, count(*) FILTER (large_predicted = c) AS said,
                     count(*) FILTER (large = c) AS support
              FROM scored, (VALUES (0), (1)) v(c) GROUP BY c))"""


def _stump(spark, d):
    return trees.gbt_grid_search(tree_items(spark, d), "pk1", "large", grid=STUMP)


@query(
    f"""
    WITH {STUMP_SQL}, {_stump_scored_sql("tested")}, {_rates_sql()}
    SELECT CAST(1 AS INTEGER) AS params_indx, class::VARCHAR AS class, precision, recall, fscore, support,
           (SELECT feature FROM stump) AS fnames, 1.0::DOUBLE AS f_importances, 1.0::DOUBLE AS gains
    FROM rates
    """
)
def gbt_grid_metrics(spark, d):
    """Metrics on the test side of a grid point whose tree SQL can grow."""
    run = _stump(spark, d)
    each = run.results.select(
        "params_indx", F.inline(F.arrays_zip(F.col("classes").alias("class"), "precision", "recall", "fscore", "support")),
    )
    named = run.results.select(
        "params_indx", F.array_join("fnames", ",").alias("fnames"),
        F.col("f_importances")[0].alias("f_importances"), F.col("gains")[0].alias("gains"),
    )
    rates = {c: rounded(c) for c in ("precision", "recall", "fscore")}
    return each.join(F.broadcast(named), "params_indx").withColumns(rates)


@query(
    f"""
    WITH {STUMP_SQL}, {_stump_scored_sql("items")}
    SELECT pk1, large, large_predicted, {round_sql("1 - p")} AS p0, {round_sql("p")} AS p1 FROM scored
    """
)
def gbt_stump_score(spark, d):
    """Scores of all rows by a model that is read back from its node table."""
    model = trees.load_model(_stump(spark, d).results, F.col("params_indx") == 1)
    found = trees.tree_score(tree_items(spark, d), "pk1", model, "large")
    shown = [rounded(F.col("large_proba_predicted")[k]).alias(f"p{k}") for k in (0, 1)]
    return found.select("pk1", "large", "large_predicted", *shown)


@query(f"WITH {STUMP_SQL} SELECT feature, CAST(1 AS BIGINT) AS splits FROM stump")
def split_importance_stump(spark, d):
    run = _stump(spark, d)
    return trees.split_importance(spark, run.model(1), run.results.first()["model_path"])


# ----------------------------------------------------- a node table written by hand

NODES = [  # tree, class_at, node, feature, cut, missing_left, left, right, value
    (0, 0, 0, "quantity", 24.0, True, 1, 2, 0.0),
    (0, 0, 1, "discount", 0.05, False, 3, 4, 0.0),
    (0, 0, 2, None, None, None, None, None, 0.7),
    (0, 0, 3, None, None, None, None, None, -0.9),
    (0, 0, 4, None, None, None, None, None, 0.15),
    (1, 0, 0, "discount", 0.03, True, 1, 2, 0.0),
    (1, 0, 1, None, None, None, None, None, -0.35),
    (1, 0, 2, "quantity", 40.0, True, 3, 4, 0.0),
    (1, 0, 3, None, None, None, None, None, 0.05),
    (1, 0, 4, "discount", 0.08, True, 5, 6, 0.0),
    (1, 0, 5, None, None, None, None, None, 0.45),
    (1, 0, 6, None, None, None, None, None, 0.8),
]

_NODE_MARGIN = """
    CASE WHEN quantity < 24 THEN CASE WHEN discount IS NOT NULL AND discount < 0.05 THEN -0.9 ELSE 0.15 END ELSE 0.7 END
    + CASE WHEN discount IS NULL OR discount < 0.03 THEN -0.35 WHEN quantity < 40 THEN 0.05
           WHEN discount < 0.08 THEN 0.45 ELSE 0.8 END"""

NODE_SQL = f"""
    {ITEMS_SQL},
    scored AS (
        SELECT pk1, large, CAST(p > 1 - p AS INTEGER) AS large_predicted, p
        FROM (SELECT *, 1 / (1 + exp(-(({_NODE_MARGIN})::DOUBLE))) AS p FROM items))"""


def node_table(spark):
    """The nodes as a stored model has them."""
    return spark.createDataFrame([(*n, 1.0, 1.0) for n in NODES], ensemble.NODE_SCHEMA)


def node_model(spark):
    features = ("discount", "quantity")
    fitted = ensemble.Ensemble.from_rows(node_table(spark), features, 2)
    splits = tuple(sorted(((f, float(n)) for f, n in fitted.splits().items()), key=lambda s: (-s[1], s[0])))
    return trees.TreeModel("gbt", features, ("discount",), (0, 1), fitted, splits)


@query(
    f"""
    WITH {NODE_SQL}
    SELECT pk1, large, large_predicted, {round_sql("1 - p")} AS p0, {round_sql("p")} AS p1 FROM scored
    """
)
def tree_score(spark, d):
    """Every order line walked through a node table."""
    found = trees.tree_score(tree_items(spark, d), "pk1", node_model(spark), "large")
    shown = [rounded(F.col("large_proba_predicted")[k]).alias(f"p{k}") for k in (0, 1)]
    return found.select("pk1", "large", "large_predicted", *shown)


# Trees of three margins: one split each.
CLASS_NODES = [
    (k, k, node, feature, cut, True, 1, 2, value) if feature else (k, k, node, None, None, None, None, None, value)
    for k, feature, cut, low, high in ((0, "year", 1995.0, 0.8, -0.6), (1, "month", 7.0, -0.2, 0.3), (2, "year", 1996.0, -0.5, 0.4))
    for node, feature, cut, value in ((0, feature, cut, 0.0), (1, None, None, low), (2, None, None, high))
]


@query(
    f"""
    WITH margins AS (
        SELECT o_orderkey, exp(if(year(o_orderdate) < 1995, 0.8, -0.6)::DOUBLE) AS a,
               exp(if(month(o_orderdate) < 7, -0.2, 0.3)::DOUBLE) AS b, exp(if(year(o_orderdate) < 1996, -0.5, 0.4)::DOUBLE) AS c
        FROM orders)
    SELECT o_orderkey, CASE WHEN a >= b AND a >= c THEN 'F' WHEN b >= c THEN 'O' ELSE 'P' END AS class_label_predicted,
           {round_sql("a / (a + b + c)")} AS p0, {round_sql("b / (a + b + c)")} AS p1, {round_sql("c / (a + b + c)")} AS p2
    FROM margins
    """
)
def tree_score_classes(spark, d):
    """Three classes: one margin and tree each, probabilities by their softmax."""
    orders = table(spark, d, "orders").select("o_orderkey", F.month("o_orderdate").alias("month"), F.year("o_orderdate").alias("year"))
    nodes = spark.createDataFrame([(*n, 1.0, 1.0) for n in CLASS_NODES], ensemble.NODE_SCHEMA)
    model = trees.TreeModel("gbt", ("month", "year"), (), ("F", "O", "P"), ensemble.Ensemble.from_rows(nodes, ("month", "year"), 3))
    found = trees.tree_score(orders, "o_orderkey", model)
    shown = [rounded(F.col("class_label_proba_predicted")[k]).alias(f"p{k}") for k in range(3)]
    return found.select("o_orderkey", "class_label_predicted", *shown)


@query(
    f"""
    WITH {NODE_SQL}, {_rates_sql()}
    SELECT class, precision, recall, fscore, support, roc_auc, 'discount,quantity' AS fnames, '3.0,2.0' AS f_importances
    FROM rates, ({_auc_sql("(SELECT large, round(p, 12) AS p FROM scored)", "large = 1", "p")})
    """
)
def tree_metrics(spark, d):
    """Metrics and ROC areas of rows scored by a node table, with its split counts."""
    scored = trees.tree_score_all(tree_items(spark, d), "pk1", node_model(spark), "large").metrics
    lists = {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("fnames", "f_importances")}
    return scored.withColumns({**{c: rounded(c) for c in ("precision", "recall", "fscore")}, **lists})


@query(
    f"""
    WITH {NODE_SQL},
    sides AS (SELECT 0 AS class, round(1 - p, 9) AS threshold, large = 0 AS hit FROM scored
              UNION ALL SELECT 1, round(p, 9), large = 1 FROM scored),
    curve AS (
        SELECT class, threshold, sum(sum(CAST(NOT hit AS INTEGER))) OVER w / (sum(sum(CAST(NOT hit AS INTEGER))) OVER (PARTITION BY class))::DOUBLE AS fpr,
               sum(sum(CAST(hit AS INTEGER))) OVER w / (sum(sum(CAST(hit AS INTEGER))) OVER (PARTITION BY class))::DOUBLE AS tpr
        FROM sides GROUP BY class, threshold WINDOW w AS (PARTITION BY class ORDER BY threshold DESC)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY threshold) - 1 AS rk FROM curve),
    wanted AS (
        SELECT class, CAST(i AS INTEGER) AS point, CAST(i AS DOUBLE) / 100 * (n - 1) AS spot
        FROM (SELECT class, count(*) AS n FROM curve GROUP BY 1), generate_series(0, 99) g(i)),
    near AS (
        SELECT class, point, a.threshold AS lo, b.threshold AS hi, a.fpr AS lo_f, b.fpr AS hi_f, a.tpr AS lo_t, b.tpr AS hi_t,
               a.threshold + (spot - floor(spot)) * (b.threshold - a.threshold) AS v
        FROM wanted JOIN ranked a USING (class) JOIN ranked b USING (class) WHERE a.rk = floor(spot) AND b.rk = ceil(spot))
    SELECT class, point, {round_sql("CASE WHEN hi - v < v - lo THEN hi_f ELSE lo_f END", 5)} AS fpr,
           {round_sql("CASE WHEN hi - v < v - lo THEN hi_t ELSE lo_t END", 5)} AS tpr,
           {round_sql("CASE WHEN hi - v < v - lo THEN hi ELSE lo END", 5)} AS threshold
    FROM near
    """
)
def tree_curves(spark, d):
    """The sampled ROC curve of both classes of rows scored by a node table."""
    found = trees.tree_score_all(tree_items(spark, d), "pk1", node_model(spark), "large", points=100).curves
    return found.withColumns({c: rounded(c, 5) for c in ("fpr", "tpr", "threshold")})

