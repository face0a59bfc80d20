"""Trainers, predictions and whole modelling runs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gradus.operators import linear, logistic, prep, trees
from gradus.plans import runs
from gradus.plans.stored import StoredModel
from gradus.queries.preparation import UNIFORM_SQL
from gradus.queries.registry import query, round_sql, rounded, table
from gradus.session import shared_folder, with_row

# ------------------------------------------------------------------ sources


def priced_items(spark, d):
    """Order lines with a label that quantity and discount explain in part."""
    noise = F.col("l_extendedprice")
    return table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("pk1"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        (noise + 3000 * F.col("l_quantity") + 2000000 * F.col("l_discount")).alias("amount"),
        (noise + 2000 * F.col("l_quantity") > 120000).cast("int").alias("large"),
    )


def workflow_items(spark, d):
    """The same with a column that repeats the quantity and one that tells nothing.

    A run has to drop both, so the SQL of the workflows knows neither.
    """
    return priced_items(spark, d).withColumns(
        {
            "bulk": 2 * F.col("quantity") + 3,
            "tag": F.conv(F.substring(F.md5("pk1"), 1, 4), 16, 10).cast("double") % 17,
        }
    )


def read_again(spark, run):
    """The run's model after it was written and read."""
    target = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    run.stored().save(spark, target)
    run.release()
    return StoredModel.load(spark, target)


ITEMS_SQL = """
    items AS (
        SELECT l_orderkey || '-' || l_linenumber AS pk1, l_quantity AS quantity, l_discount AS discount,
               l_extendedprice + 3000 * l_quantity + 2000000 * l_discount AS amount,
               CAST(l_extendedprice + 2000 * l_quantity > 120000 AS INTEGER) AS large
        FROM lineitem)"""

# Items whose key is unique, with normalised features and the split.
CLEAN_SQL = f"""{ITEMS_SQL},
    clean AS (SELECT * FROM items WHERE pk1 IN (SELECT pk1 FROM items GROUP BY pk1 HAVING count(*) = 1)),
    scale AS (
        SELECT avg(quantity) AS mq, stddev_samp(quantity) AS sq, avg(discount) AS md, stddev_samp(discount) AS sd FROM clean),
    norm AS MATERIALIZED (
        SELECT pk1, amount, large, (quantity - mq) / sq AS q, (discount - md) / sd AS dd,
               {UNIFORM_SQL.format(seed=42, key="pk1")} <= 0.8 AS train
        FROM clean, scale)"""


def ols_sql(source: str, x1: str, x2: str, y: str, name: str) -> str:
    """Least squares of y on two features and a constant, in closed form."""
    return f"""
    {name}_m AS (
        SELECT count(*)::DOUBLE AS n, avg({x1}) AS m1, avg({x2}) AS m2, avg({y}) AS my,
               var_samp({x1}) AS s11, var_samp({x2}) AS s22, covar_samp({x1}, {x2}) AS s12,
               covar_samp({x1}, {y}) AS s1y, covar_samp({x2}, {y}) AS s2y, var_samp({y}) AS syy
        FROM {source}),
    {name}_b AS (
        SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
               (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM {name}_m),
    {name} AS MATERIALIZED (
        SELECT *, my - b1 * m1 - b2 * m2 AS b0, 1 - (syy - b1 * s1y - b2 * s2y) / syy AS r2,
               (n - 1) * (syy - b1 * s1y - b2 * s2y) / (n - 3) AS sigma2, s11 * s22 - s12 * s12 AS det
        FROM {name}_b)"""


# --------------------------------------------------------- linear regression


def _coefficient_rows(model, spark, places):
    rows = linear_rows(model, spark)
    return rows.select(
        "feature",
        rounded("coef", places).alias("coef"),
        (F.col("p_value") < 0.05).alias("significant"),
    )


def linear_rows(model, spark):
    return spark.createDataFrame(
        list(zip(model.names, model.coef, model.p_values)), "feature string, coef double, p_value double"
    )


@query(
    f"""
    WITH {ITEMS_SQL}, {ols_sql("items", "quantity", "discount", "amount", "fit")}
    SELECT 'constant_term' AS feature, {round_sql("b0", 3)} AS coef, {round_sql("r2")} AS r2,
           abs(b0) / sqrt(sigma2 * (1 / n + (m1 * m1 * s22 - 2 * m1 * m2 * s12 + m2 * m2 * s11) / det / (n - 1))) > 1.96 AS significant
    FROM fit
    UNION ALL SELECT 'quantity', {round_sql("b1", 3)}, {round_sql("r2")}, abs(b1) / sqrt(sigma2 * s22 / det / (n - 1)) > 1.96 FROM fit
    UNION ALL SELECT 'discount', {round_sql("b2", 3)}, {round_sql("r2")}, abs(b2) / sqrt(sigma2 * s11 / det / (n - 1)) > 1.96 FROM fit
    """
)
def linreg_train(spark, d):
    model = linear.linreg_train(priced_items(spark, d), ["quantity", "discount"], "amount")
    return _coefficient_rows(model, spark, 3).withColumn("r2", rounded(F.lit(model.r2)))


@query(
    f"""
    WITH {ITEMS_SQL}, y AS (SELECT quantity, discount, 1000 * discount + CAST(large AS DOUBLE) * 0 + amount % 7 AS v FROM items),
    {ols_sql("y", "quantity", "discount", "v", "fit")}
    SELECT 'constant_term' AS feature, 1 AS mask
    UNION ALL SELECT 'discount', CAST(abs(b2) / sqrt(sigma2 * s11 / det / (n - 1)) > 1.96 AS INTEGER) FROM fit
    UNION ALL SELECT 'quantity', CAST(abs(b1) / sqrt(sigma2 * s22 / det / (n - 1)) > 1.96 AS INTEGER) FROM fit
    """
)
def significance_mask(spark, d):
    target = priced_items(spark, d).withColumn("v", 1000 * F.col("discount") + F.col("amount") % 7)
    model = linear.linreg_train(target, ["quantity", "discount"], "v").to_df(spark)
    mask = linear.significance_mask(model)
    return with_row(model, mask).select(
        F.inline(F.arrays_zip(F.col("names").alias("feature"), F.col("mask_arr").alias("mask")))
    )


LINEAR_SQL = f"""
    WITH {CLEAN_SQL}, training AS (SELECT * FROM norm WHERE train), {ols_sql("training", "q", "dd", "amount", "fit")}"""


def _linear(spark, d):
    items = workflow_items(spark, d).drop("large")
    return runs.linear_run(items, "pk1", "amount", vif_step_limit=3, train_fraction=0.8)


@query(
    f"""
    {LINEAR_SQL}, tested AS (SELECT pk1, amount, b0 + b1 * q + b2 * dd AS prediction FROM norm, fit WHERE NOT train)
    SELECT pk1, {round_sql("amount", 2)} AS amount, {round_sql("prediction", 2)} AS prediction,
           {round_sql("amount - prediction", 2)} AS residual,
           {round_sql("(SELECT 1 - pow(stddev_samp(amount - prediction), 2) / pow(stddev_samp(amount), 2) FROM tested)", 6)} AS r_square
    FROM tested
    """
)
def linear_workflow(spark, d):
    shown = _linear(spark, d).residuals
    return shown.withColumns(
        {c: rounded(c, 2) for c in ("amount", "prediction", "residual")} | {"r_square": rounded("r_square")}
    )


@query(
    f"""
    {LINEAR_SQL}
    SELECT 'discount' AS selected_feature, {round_sql("b2", 2)} AS coefficient, 0.0::DOUBLE AS p_value FROM fit WHERE b2 > 0
    UNION ALL SELECT 'quantity', {round_sql("b1", 2)}, 0.0 FROM fit WHERE b1 > 0
    """
)
def linear_workflow_coefficients(spark, d):
    return _linear(spark, d).top_positive


@query(
    f"""
    {LINEAR_SQL}
    SELECT pk1, {round_sql("b0 + b1 * q + b2 * dd", 2)} AS prediction FROM norm, fit
    """
)
def linear_score(spark, d):
    model = read_again(spark, _linear(spark, d))
    scored = model.score(workflow_items(spark, d).drop("amount", "large"), "pk1")
    return scored.withColumn("prediction", rounded("prediction", 2))


# ---------------------------------------------------------------- elastic net

def elastic_sql(source: str, rounds: int = 25) -> str:
    """Coordinate descent on two features: each slope is a soft threshold over a damped variance."""

    def slope(pull: str, variance: str) -> str:
        return f"sign({pull}) * greatest(abs({pull}) - 0.05 * 0.05, 0) / ({variance} + 0.05 * (1 - 0.05))"

    steps = ["fit_0 AS (SELECT 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)"]
    for i in range(1, rounds + 1):
        steps.append(
            f"fit_{i} AS MATERIALIZED (SELECT b1, {slope('(c2 - s12 * b1)', 's22')} AS b2 FROM fit_m,"
            f" (SELECT {slope('(c1 - s12 * b2)', 's11')} AS b1 FROM fit_m, fit_{i - 1}))"
        )
    return f"""
    fit_m AS MATERIALIZED (
        SELECT avg(q) AS m1, avg(dd) AS m2, avg(amount) AS my, covar_pop(q, amount) AS c1, covar_pop(dd, amount) AS c2,
               var_pop(q) AS s11, var_pop(dd) AS s22, covar_pop(q, dd) AS s12 FROM {source}),
    {", ".join(steps)},
    fit AS MATERIALIZED (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM fit_m, fit_{rounds})"""


def _elastic_items(spark, d):
    return priced_items(spark, d).drop("large")


def _elastic(spark, d):
    return runs.elastic_net_run(_elastic_items(spark, d), "pk1", "amount", tol=1e-12)


@query(
    f"""
    WITH {ITEMS_SQL}, z AS (
        SELECT avg(quantity) AS mq, stddev_samp(quantity) AS sq, avg(discount) AS md, stddev_samp(discount) AS sd FROM items),
    training AS (SELECT (quantity - mq) / sq AS q, (discount - md) / sd AS dd, amount FROM items, z), {elastic_sql("training")}
    SELECT 'quantity' AS feature, {round_sql("b1", 3)} AS coef, {round_sql("b0", 3)} AS intercept FROM fit
    UNION ALL SELECT 'discount', {round_sql("b2", 3)}, {round_sql("b0", 3)} FROM fit
    """
)
def elastic_net_train(spark, d):
    items = _elastic_items(spark, d)
    stats = prep.FeatureStats.fit(items, ["quantity", "discount"])
    rows = prep.normalise_wide(items, stats, ["pk1", "amount"])
    model = linear.elastic_net_train(rows, ["quantity", "discount"], "amount", tol=1e-12)
    return spark.createDataFrame(
        [(f, c, model.intercept) for f, c in zip(model.names, model.coef)],
        "feature string, coef double, intercept double",
    ).withColumns({"coef": rounded("coef", 3), "intercept": rounded("intercept", 3)})


@query(
    f"""
    WITH {CLEAN_SQL}, training AS (SELECT * FROM norm WHERE train), {elastic_sql("training")},
    tested AS (SELECT pk1, amount, b0 + b1 * q + b2 * dd AS prediction FROM norm, fit WHERE NOT train)
    SELECT pk1, {round_sql("prediction", 2)} AS prediction, {round_sql("amount - prediction", 2)} AS residual,
           {round_sql("(SELECT 1 - pow(stddev_samp(amount - prediction), 2) / pow(stddev_samp(amount), 2) FROM tested)", 6)} AS r_square
    FROM tested
    """
)
def elastic_net_workflow(spark, d):
    shown = _elastic(spark, d).residuals
    return shown.select(
        "pk1",
        rounded("prediction", 2).alias("prediction"),
        rounded("residual", 2).alias("residual"),
        rounded("r_square").alias("r_square"),
    )


@query(
    f"""
    WITH {CLEAN_SQL}, training AS (SELECT * FROM norm WHERE train), {elastic_sql("training")}
    SELECT pk1, {round_sql("b0 + b1 * q + b2 * dd", 2)} AS prediction FROM norm, fit
    """
)
def elastic_net_score(spark, d):
    model = read_again(spark, _elastic(spark, d))
    scored = model.score(_elastic_items(spark, d).drop("amount"), "pk1")
    return scored.withColumn("prediction", rounded("prediction", 2))


# ------------------------------------------------------------------- logistic


def irls_sql(source: str, x: str, y: str, name: str, steps: int = 12) -> str:
    """Newton steps of a logistic regression on a constant and one feature."""
    parts = [
        f"{name}_g AS MATERIALIZED (SELECT {x} AS x, count(*)::DOUBLE AS n, sum({y})::DOUBLE AS s FROM {source} GROUP BY 1)",
        f"{name}_0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS h00, 0.0::DOUBLE AS h11, 1.0::DOUBLE AS det)",
    ]
    for i in range(1, steps + 1):
        last = name if i == steps else f"{name}_{i}"
        parts.append(
            f"""{last} AS MATERIALIZED (
            SELECT b0 + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS b0,
                   b1 + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS b1, h00, h11, h00 * h11 - h01 * h01 AS det
            FROM (SELECT any_value(b0) AS b0, any_value(b1) AS b1, sum(n * p * (1 - p)) AS h00, sum(n * p * (1 - p) * x) AS h01,
                         sum(n * p * (1 - p) * x * x) AS h11, sum(s - n * p) AS g0, sum((s - n * p) * x) AS g1
                  FROM (SELECT x, n, s, b0, b1, 1 / (1 + exp(-(b0 + b1 * x))) AS p FROM {name}_g, {name}_{i - 1})))"""
        )
    return ", ".join(parts)


@query(
    f"""
    WITH {ITEMS_SQL}, {irls_sql("items", "quantity", "large", "fit")}
    SELECT 'constant_term' AS feature, {round_sql("b0")} AS coef, abs(b0) / sqrt(h11 / det) > 1.96 AS significant FROM fit
    UNION ALL SELECT 'quantity', {round_sql("b1")}, abs(b1) / sqrt(h00 / det) > 1.96 FROM fit
    """
)
def logreg_train(spark, d):
    return _coefficient_rows(logistic.logreg_train(priced_items(spark, d), ["quantity"], "large"), spark, 6)


def logistic_items(spark, d):
    return workflow_items(spark, d).select("pk1", "quantity", "bulk", "tag", "large")


def _logistic(spark, d):
    return runs.logistic_run(
        logistic_items(spark, d), "pk1", "large", vif_step_limit=2, train_fraction=0.8, folds=2, pos_class_weight=1.2
    )


def _sample_sql(i: int) -> str:
    return f"sample{i} AS (SELECT * FROM norm WHERE train AND floor({UNIFORM_SQL.format(seed=f'42-{i}', key='pk1')} * 2) <> {i - 1})"


LOGISTIC_SQL = f"""
    WITH {CLEAN_SQL}, {_sample_sql(1)}, {_sample_sql(2)}, {irls_sql("sample1", "q", "large", "f1")}, {irls_sql("sample2", "q", "large", "f2")},
    tested AS MATERIALIZED (
        SELECT pk1, large, (1 / (1 + exp(-(f1.b0 + f1.b1 * q))) + 1 / (1 + exp(-(f2.b0 + f2.b1 * q)))) / 2 * 1.2 AS prob
        FROM norm, f1, f2 WHERE NOT train)"""


def metrics_sql(source: str, label: str, prob: str) -> str:
    """Metrics at 101 thresholds from a table of rows."""

    def guard(x: str) -> str:
        return f"({x} + 0.001::DOUBLE * CAST({x} = 0 AS INTEGER))"

    rates = f"""
        SELECT t, tp / {guard("(tp + fp)")} AS pp, tp / {guard("p")} AS rp, tn / {guard("(all_rows - tp - fp)")} AS pn,
               tn / {guard("n")} AS rn, fp / {guard("n")} AS fpr
        FROM (SELECT CAST(i AS DOUBLE) / 100 AS t, sum(CASE WHEN y = 1 AND prob > CAST(i AS DOUBLE) / 100 THEN k ELSE 0 END)::DOUBLE AS tp,
                     sum(CASE WHEN y = 0 AND prob > CAST(i AS DOUBLE) / 100 THEN k ELSE 0 END)::DOUBLE AS fp,
                     sum(CASE WHEN y = 0 AND prob <= CAST(i AS DOUBLE) / 100 THEN k ELSE 0 END)::DOUBLE AS tn,
                     sum(CASE WHEN y = 1 THEN k ELSE 0 END)::DOUBLE AS p, sum(CASE WHEN y = 0 THEN k ELSE 0 END)::DOUBLE AS n,
                     sum(k)::DOUBLE AS all_rows
              FROM (SELECT {label} AS y, {prob} AS prob, count(*) AS k FROM {source} GROUP BY 1, 2), generate_series(0, 100) g(i)
              GROUP BY i)"""
    return f"""
        SELECT t AS threshold, {round_sql("pp")} AS precision_p, {round_sql("rp")} AS recall_p,
               {round_sql("2 * pp * rp / " + guard("(pp + rp)"))} AS f1_score_p, {round_sql("pn")} AS precision_n,
               {round_sql("rn")} AS recall_n, {round_sql("2 * pn * rn / " + guard("(pn + rn)"))} AS f1_score_n, {round_sql("fpr")} AS fpr
        FROM ({rates})"""


def shown_metrics(metrics):
    return metrics.withColumns({c: rounded(c) for c in metrics.columns if c != "threshold"})


@query(f"{LOGISTIC_SQL} {metrics_sql('tested', 'large', 'prob')}")
def logistic_workflow(spark, d):
    return shown_metrics(_logistic(spark, d).metrics)


@query(f"{LOGISTIC_SQL} SELECT pk1, large, {round_sql('prob')} AS avg_pred_prob FROM tested")
def logistic_workflow_probabilities(spark, d):
    found = _logistic(spark, d).probabilities
    return found.withColumn("avg_pred_prob", rounded("avg_pred_prob"))


@query(
    f"""
    {LOGISTIC_SQL}
    SELECT pk1, {round_sql("(1 / (1 + exp(-(f1.b0 + f1.b1 * q))) + 1 / (1 + exp(-(f2.b0 + f2.b1 * q)))) / 2")} AS pred_prob
    FROM norm, f1, f2
    """
)
def logistic_score(spark, d):
    model = read_again(spark, _logistic(spark, d))
    scored = model.score(logistic_items(spark, d).drop("large"), "pk1")
    return scored.withColumn("pred_prob", rounded("pred_prob"))


# ---------------------------------------------------------------- predictions


def _weights(*coef):
    return linear.LinearModel(("constant_term", "discount", "quantity"), coef)


@query(f"SELECT l_orderkey, l_linenumber, {round_sql('12.5 + 3 * l_discount - 0.25 * l_quantity')} AS prediction FROM lineitem")
def linreg_predict(spark, d):
    items = table(spark, d, "lineitem").withColumnsRenamed({"l_discount": "discount", "l_quantity": "quantity"})
    shown = linear.predict(items, _weights(12.5, 3.0, -0.25), ["l_orderkey", "l_linenumber"])
    return shown.withColumn("prediction", rounded("prediction"))


@query(
    f"""
    SELECT l_orderkey, l_linenumber, {round_sql('1 / (1 + exp(-(0.5 + 3 * l_discount - 0.05 * l_quantity)))')} AS pred_prob
    FROM lineitem
    """
)
def logreg_predict_prob(spark, d):
    items = table(spark, d, "lineitem").withColumnsRenamed({"l_discount": "discount", "l_quantity": "quantity"})
    shown = linear.predict_probability(items, _weights(0.5, 3.0, -0.05), ["l_orderkey", "l_linenumber"])
    return shown.withColumn("pred_prob", rounded("pred_prob"))


@query(f"SELECT l_orderkey, l_linenumber, {round_sql('7 + 2 * l_tax - 0.5 * l_quantity')} AS prediction FROM lineitem")
def elastic_net_predict(spark, d):
    model = linear.LinearModel(("l_quantity", "l_tax"), (-0.5, 2.0), (), 7.0)
    shown = linear.predict(table(spark, d, "lineitem"), model, ["l_orderkey", "l_linenumber"])
    return shown.withColumn("prediction", rounded("prediction"))


# ---------------------------------------------------------------------- trees


@query(
    f"""
    WITH c AS (SELECT o_orderstatus AS class, count(*) AS n FROM orders GROUP BY 1), t AS (SELECT sum(n) AS total FROM c)
    SELECT class, {round_sql("(total / n) / (SELECT sum(total / n) FROM c, t)")} AS weight FROM c, t
    """
)
def class_weights(spark, d):
    return trees.class_weights(table(spark, d, "orders"), "o_orderstatus").withColumn("weight", rounded("weight"))


@query("SELECT DISTINCT o_orderstatus AS class, CASE o_orderstatus WHEN 'F' THEN 0.25 WHEN 'O' THEN 0.5 ELSE 0.75 END::DOUBLE AS weight FROM orders")
def class_weights_given(spark, d):
    return trees.class_weights(table(spark, d, "orders"), "o_orderstatus", {"F": 0.25, "O": 0.5, "P": 0.75})


@query("SELECT DISTINCT o_custkey AS class, round(1.0::DOUBLE / (1 + o_custkey % 97), 6) AS weight FROM orders")
def class_weights_many(spark, d):
    """Weights given for every customer who orders, many more classes than a label has as a rule."""
    orders = table(spark, d, "orders")
    keys = orders.select(F.col("o_custkey").alias("class")).where("class IS NOT NULL").distinct()
    given = keys.withColumn("weight", 1.0 / (1 + F.col("class") % 97))
    weights = trees.class_weights(orders, "o_custkey", given)
    return weights.withColumn("weight", rounded("weight"))


def tree_items(spark, d):
    """Order lines with a nullable feature and a label two features explain."""
    return table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").alias("pk1"),
        F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_linenumber") != 1, F.col("l_discount")).alias("discount"),
        F.col("l_tax").alias("tax"),
        (F.col("l_extendedprice") + 1500 * F.col("l_quantity") + 400000 * F.col("l_discount") > 120000).cast("int").alias("large"),
    )


GRID = {
    "learning_rate": [0.1, 0.3],
    "max_depth": [2, 3],
    "subsample": [0.85],
    "colsample_bytree": [0.85],
    "min_child_weight": [10],
    "n_estimators": [4],
}


@query()
def gbt_grid_search(spark, d):
    return trees.gbt_grid_search(tree_items(spark, d), "pk1", "large", grid=GRID).results.drop("mdl_train_ts", "model_path")


@query()
def gbt_grid_search_classes(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.dayofyear("o_orderdate").alias("day"))
    run = trees.gbt_grid_search(orders, "o_orderkey", "o_orderstatus", grid={"max_depth": [2], "n_estimators": [2]})
    return run.results.drop("mdl_train_ts", "model_path")


@query()
def rf_grid_search(spark, d):
    vectors = table(spark, d, "embeddings")
    wide = vectors.select("vec_id", "label", *[F.col("embedding")[i].alias(f"e{i:02d}") for i in range(64)])
    run = trees.rf_grid_search(
        wide, "vec_id", "label", grid={"max_depth": [5], "min_samples_split": [17], "n_estimators": [10]}
    )
    return run.results.drop("mdl_train_ts", "model_path")


def _best(spark, d):
    run = trees.gbt_grid_search(tree_items(spark, d), "pk1", "large", grid={k: v[-1] for k, v in GRID.items()})
    return run.model(1)


@query()
def gbt_score(spark, d):
    return trees.tree_score(tree_items(spark, d), "pk1", _best(spark, d), "large")


@query()
def gbt_score_metrics(spark, d):
    return trees.tree_score_all(tree_items(spark, d), "pk1", _best(spark, d), "large").metrics


@query()
def gbt_score_curves(spark, d):
    return trees.tree_score_all(tree_items(spark, d), "pk1", _best(spark, d), "large", points=100).curves


# What the split alone settles in a grid: the points, the inputs and the tested rows of each class.
TESTED_SQL = """
    drawn AS (SELECT *, {uniform} AS u FROM {source}),
    tested AS (
        SELECT * FROM (SELECT *, row_number() OVER (ORDER BY u, {key}) AS rn FROM drawn WHERE u > 0.8)
        WHERE rn <= (SELECT floor(count(*) * (1 - 0.8::DOUBLE)) FROM drawn))"""


@query(
    f"""
    WITH items AS (
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_suppkey, l_partkey) AS pk1,
               CAST(l_extendedprice + 1500 * l_quantity + 400000 * l_discount > 120000 AS INTEGER) AS large FROM lineitem),
    {TESTED_SQL.format(uniform=UNIFORM_SQL.format(seed=42, key="pk1"), source="items", key="pk1")}
    SELECT CAST(i AS INTEGER) AS params_indx, 'learning_rate=' || rate || ', max_depth=' || depth
               || ', subsample=0.85, colsample_bytree=0.85, min_child_weight=10, n_estimators=4' AS params,
           'discount,quantity,tax' AS features, 'discount' AS nullable, '0,1' AS classes,
           (SELECT string_agg(n, ',' ORDER BY large) FROM (SELECT large, count(*) AS n FROM tested GROUP BY 1)) AS support
    FROM (VALUES (1, '0.1', 2), (2, '0.1', 3), (3, '0.3', 2), (4, '0.3', 3)) v(i, rate, depth)
    """
)
def gbt_grid_settings(spark, d):
    found = trees.gbt_grid_search(tree_items(spark, d), "pk1", "large", grid=GRID).results
    lists = ("features", "nullable", "classes", "support")
    return found.select("params_indx", "params", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in lists])


@query(
    f"""
    WITH {TESTED_SQL.format(uniform=UNIFORM_SQL.format(seed=42, key="o_orderkey"), source="orders", key="o_orderkey")},
    said AS (SELECT o_custkey % 160 AS band, count(*) AS n FROM tested GROUP BY 1)
    SELECT CAST(k AS VARCHAR) AS band, coalesce(n, 0) AS support
    FROM (SELECT DISTINCT o_custkey % 160 AS k FROM drawn WHERE u <= 0.8) LEFT JOIN said ON band = k
    """
)
def rf_grid_search_many_classes(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 160).alias("band"), "o_totalprice", F.dayofyear("o_orderdate").alias("day")
    )
    found = trees.rf_grid_search(orders, "o_orderkey", "band", grid={"max_depth": [3], "n_estimators": [2]}).results
    return found.select(F.inline(F.arrays_zip(F.col("classes").alias("band"), "support")))


@query()
def split_importance(spark, d):
    run = trees.gbt_grid_search(tree_items(spark, d), "pk1", "large", grid={k: v[-1] for k, v in GRID.items()})
    return trees.split_importance(spark, run.model(1), run.results.first()["model_path"])
