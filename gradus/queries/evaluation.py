"""Evaluation of scored tables and of models."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradus.operators import evaluate
from gradus.queries.models import metrics_sql, shown_metrics
from gradus.queries.registry import query, round_sql, rounded, table

# ------------------------------------------------------------------ sources


def scored_items(spark, d):
    """Order lines with a probability from their price and a 0/1 label."""
    price = F.col("l_extendedprice")
    return table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").alias("pk1"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-(price - 50000) / 20000))).alias("prob"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )


SCORED_SQL = """
    scored AS (
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_suppkey || '-' || l_partkey AS pk1,
               1 / (1 + exp(-(l_extendedprice - 50000) / 20000)) AS prob, CAST(l_returnflag = 'R' AS INTEGER) AS label
        FROM lineitem)"""


def tied_items(spark, d):
    return scored_items(spark, d).withColumn("prob", F.round("prob", 3))


TIED_SQL = f"{SCORED_SQL}, tied AS (SELECT pk1, round(prob, 3) AS prob, label FROM scored)"


def sampled_models(spark, d):
    """Three model rows, whose features are the brands and a constant term."""
    brands = table(spark, d, "part").groupBy("p_brand").agg(
        F.avg("p_retailprice").alias("price"), F.avg("p_size").alias("size")
    )
    out = []
    for sample in (1, 2, 3):
        terms = brands.select(
            F.struct(
                F.col("p_brand").alias("name"),
                (F.col("price") - 1000 - 10 * sample).alias("coef"),
                (F.col("size") / 500).alias("p"),
            ).alias("t")
        )
        sorted_terms = F.array_sort(F.collect_list("t"))
        constant = F.struct(F.lit("constant_term").alias("name"), F.lit(5.0).alias("coef"), F.lit(0.0).alias("p"))
        every = F.concat(sorted_terms, F.array(constant))
        out.append(
            terms.agg(every.alias("ts")).select(
                F.transform("ts", lambda t: t["name"]).alias("names"),
                F.transform("ts", lambda t: t["coef"]).alias("coef"),
                F.transform("ts", lambda t: t["p"]).alias("p_values"),
            )
        )
    return out


MODEL_SQL = """
    brands AS (SELECT p_brand, avg(p_retailprice) AS price, avg(p_size) / 500 AS p FROM part GROUP BY 1),
    model AS (
        SELECT p_brand AS selected_feature, price - 1000 - 10 * sample AS coef, p AS p_value, sample
        FROM brands, (SELECT unnest([1, 2, 3]) AS sample)),
    ranks AS (
        SELECT selected_feature, p_value, coef, sample, cume_dist() OVER (PARTITION BY sample ORDER BY abs(coef)) AS relative_rank
        FROM model WHERE p_value < 0.05)"""


# ----------------------------------------------------------------- regression


@query(
    f"""
    WITH x AS (SELECT o_orderkey, o_totalprice AS actual, 200000 + 100 * dayofyear(o_orderdate)::DOUBLE AS prediction FROM orders)
    SELECT o_orderkey, actual, prediction, {round_sql("actual - prediction", 4)} AS residual,
           {round_sql("(SELECT 1 - pow(stddev_samp(actual - prediction), 2) / pow(stddev_samp(actual), 2) FROM x)")} AS r_square
    FROM x
    """
)
def residual_report(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("actual"),
        (200000 + 100 * F.dayofyear("o_orderdate").cast("double")).alias("prediction"),
    )
    report = evaluate.residual_report(rows, "o_orderkey", "actual", "prediction")
    return report.withColumns({"residual": rounded("residual", 4), "r_square": rounded("r_square")})


def _top_sql(condition: str, order: str) -> str:
    return f"""
        WITH {MODEL_SQL}
        SELECT selected_feature, {round_sql("coef", 2)} AS coefficient, {round_sql("p_value", 2)} AS p_value
        FROM model WHERE sample = 1 AND p_value < 0.05 AND {condition}
        ORDER BY {round_sql("coef", 2)} {order}, selected_feature LIMIT 20"""


@query(_top_sql("coef > 0", "DESC"))
def top_coefficients(spark, d):
    return evaluate.top_coefficients(sampled_models(spark, d)[0])


@query(_top_sql("coef < 0", "ASC"))
def top_negative_coefficients(spark, d):
    return evaluate.top_coefficients(sampled_models(spark, d)[0], positive=False)


@query(f"WITH {MODEL_SQL} SELECT selected_feature, {round_sql('coef')} AS coef, {round_sql('p_value')} AS p_value, sample, {round_sql('relative_rank')} AS relative_rank FROM ranks")
def relative_rank(spark, d):
    models = sampled_models(spark, d)
    ranks = evaluate.relative_rank(models[0], 1)
    for i, model in enumerate(models[1:], start=2):
        ranks = ranks.unionByName(evaluate.relative_rank(model, i))
    return ranks.withColumns({c: rounded(c) for c in ("coef", "p_value", "relative_rank")})


@query(
    f"""
    WITH {MODEL_SQL}
    SELECT selected_feature, {round_sql("avg(relative_rank)")} AS feature_importance FROM ranks GROUP BY 1
    """
)
def feature_importance(spark, d):
    models = sampled_models(spark, d)
    ranks = evaluate.relative_rank(models[0], 1)
    for i, model in enumerate(models[1:], start=2):
        ranks = ranks.unionByName(evaluate.relative_rank(model, i))
    return evaluate.feature_importance(ranks).withColumn("feature_importance", rounded("feature_importance"))


@query(
    f"""
    WITH p AS (SELECT round(avg(p_size) / 500, 3) + 0.0 AS p_value FROM part GROUP BY p_brand)
    SELECT p_value, {round_sql("count(*) OVER (ORDER BY p_value) / (SELECT count(*) FROM p)::DOUBLE")} AS cdf
    FROM (SELECT DISTINCT p_value FROM p)
    """
)
def p_value_cdf(spark, d):
    sizes = table(spark, d, "part").groupBy("p_brand").agg(F.round(F.avg("p_size") / 500, 3).alias("p"))
    model = sizes.agg(F.collect_list("p").alias("p_values"))
    return evaluate.p_value_cdf(model).withColumn("cdf", rounded("cdf"))


# ------------------------------------------------------------ threshold sweep


@query(
    f"""
    WITH scored AS (SELECT c_custkey, 1 / (1 + exp(-(c_acctbal - 5000) / 2000)) AS prob FROM customer)
    SELECT c_custkey, {round_sql("prob")} AS prob, CAST(i AS DOUBLE) / 100 AS threshold,
           CASE WHEN prob > CAST(i AS DOUBLE) / 100 THEN 1 ELSE 0 END AS pred_class
    FROM scored, generate_series(0, 100) g(i)
    """
)
def threshold_sweep(spark, d):
    scored = table(spark, d, "customer").select(
        "c_custkey", (F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("c_acctbal") - 5000) / 2000))).alias("prob")
    )
    return evaluate.threshold_sweep(scored, "prob", ["c_custkey"]).withColumn("prob", rounded("prob"))


@query(f"WITH {SCORED_SQL} {metrics_sql('scored', 'label', 'prob')}")
def eval_metrics(spark, d):
    return shown_metrics(evaluate.eval_metrics(scored_items(spark, d), "label", "prob"))


@query(f"WITH hundredths AS (SELECT l_discount * 10 AS prob, CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem) {metrics_sql('hundredths', 'label', 'prob')}")
def eval_metrics_at_thresholds(spark, d):
    """Scores that fall on the thresholds themselves."""
    rows = table(spark, d, "lineitem").select(
        (F.col("l_discount") * 10).alias("prob"), (F.col("l_returnflag") == "R").cast("int").alias("label")
    )
    return shown_metrics(evaluate.eval_metrics(rows, "label", "prob"))


@query(
    f"""
    SELECT l_orderkey, CAST(l_returnflag = 'R' AS INTEGER) AS label, {round_sql("avg(l_discount) * 11")} AS avg_pred_prob
    FROM lineitem GROUP BY 1, 2
    """
)
def ensemble_probability(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", (F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_discount").alias("pred_prob")
    )
    mean = evaluate.ensemble_probability(rows, "l_orderkey", "label", pos_class_weight=11.0)
    return mean.withColumn("avg_pred_prob", rounded("avg_pred_prob"))


# -------------------------------------------------------------- class metrics


def judged_items(spark, d):
    """Three actual classes, four predicted ones."""
    said = (
        F.when(F.col("l_discount") > 0.09, "X")
        .when(F.col("l_quantity") < 20, "A")
        .when(F.col("l_quantity") < 35, "N")
        .otherwise("R")
    )
    return table(spark, d, "lineitem").select(F.col("l_returnflag").alias("actual"), said.alias("predicted"))


JUDGED_SQL = """
    judged AS (
        SELECT l_returnflag AS actual, CASE WHEN l_discount > 0.09 THEN 'X' WHEN l_quantity < 20 THEN 'A'
               WHEN l_quantity < 35 THEN 'N' ELSE 'R' END AS predicted FROM lineitem)"""


@query(
    f"""
    WITH {JUDGED_SQL}, c AS (
        SELECT class, count(*) FILTER (actual = class) AS support, count(*) FILTER (predicted = class)::DOUBLE AS said,
               count(*) FILTER (actual = class AND predicted = class)::DOUBLE AS hit
        FROM judged, (SELECT actual AS class FROM judged UNION SELECT predicted FROM judged) GROUP BY class),
    r AS (SELECT class, support, CASE WHEN said > 0 THEN hit / said ELSE 0 END AS p, CASE WHEN support > 0 THEN hit / support ELSE 0 END AS r FROM c)
    SELECT class, {round_sql("p")} AS "precision", {round_sql("r")} AS recall,
           {round_sql("CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END")} AS fscore, support
    FROM r
    """
)
def class_metrics(spark, d):
    rated = evaluate.class_metrics(judged_items(spark, d), "actual", "predicted")
    return rated.withColumns({c: rounded(c) for c in ("precision", "recall", "fscore")})


@query(
    f"""
    WITH {JUDGED_SQL}
    SELECT actual, {", ".join(f"count(*) FILTER (predicted = '{c}') AS predicted_{c}" for c in "ANRX")}
    FROM judged GROUP BY actual
    """
)
def confusion_matrix(spark, d):
    return evaluate.confusion_matrix(judged_items(spark, d), "actual", "predicted")


# ------------------------------------------------------------------------ ROC


def _auc_sql(source: str, hit: str, prob: str) -> str:
    return f"""
        SELECT round((sum(rk) FILTER (hit) - sum(CAST(hit AS INTEGER)) * (sum(CAST(hit AS INTEGER)) + 1) / 2.0)
               / (sum(CAST(hit AS INTEGER))::DOUBLE * sum(CAST(NOT hit AS INTEGER))), 5) AS roc_auc
        FROM (SELECT {hit} AS hit, rank() OVER (ORDER BY {prob}) + (count(*) OVER (PARTITION BY {prob}) - 1) / 2.0::DOUBLE AS rk FROM {source})"""


@query(f"WITH {TIED_SQL} {_auc_sql('tied', 'label = 1', 'prob')}")
def roc_auc(spark, d):
    return evaluate.roc_auc(tied_items(spark, d), "label", "prob")


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS class, roc_auc FROM ({_auc_sql('orders', f'o_orderpriority = {chr(39)}{c}{chr(39)}', f'o_totalprice * {i + 1}')})"
        for i, c in enumerate(PRIORITIES)
    )
)
def roc_auc_per_class(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderpriority", F.array(*[F.col("o_totalprice") * (i + 1) for i in range(5)]).alias("scores")
    )
    return evaluate.roc_auc_per_class(rows, "o_orderpriority", "scores", PRIORITIES)


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS class, threshold,
        {round_sql(f"(sum(sum(CAST(o_orderpriority <> '{c}' AS INTEGER))) OVER (ORDER BY threshold DESC))::DOUBLE / (SELECT count(*) FROM orders WHERE o_orderpriority <> '{c}')")} AS fpr,
        {round_sql(f"(sum(sum(CAST(o_orderpriority = '{c}' AS INTEGER))) OVER (ORDER BY threshold DESC))::DOUBLE / (SELECT count(*) FROM orders WHERE o_orderpriority = '{c}')")} AS tpr
        FROM (SELECT o_orderpriority, floor(o_totalprice / {1000 * (i + 1)}) * 1.0::DOUBLE AS threshold FROM orders) GROUP BY threshold"""
        for i, c in enumerate(PRIORITIES)
    )
)
def roc_curve_per_class(spark, d):
    scores = [F.floor(F.col("o_totalprice") / (1000 * (i + 1))).cast("double") for i in range(5)]
    rows = table(spark, d, "orders").select("o_orderpriority", F.array(*scores).alias("scores"))
    curve = evaluate.roc_curve_per_class(rows, "o_orderpriority", "scores", PRIORITIES)
    return curve.withColumns({"fpr": rounded("fpr"), "tpr": rounded("tpr")})


CURVE_SQL = f"""
    {TIED_SQL}, curve AS (
        SELECT prob AS threshold, (sum(sum(1 - label)) OVER w)::DOUBLE / (SELECT sum(1 - label) FROM tied) AS fpr,
               (sum(sum(label)) OVER w)::DOUBLE / (SELECT sum(label) FROM tied) AS tpr
        FROM tied GROUP BY prob WINDOW w AS (ORDER BY prob DESC))"""


@query(f"WITH {CURVE_SQL} SELECT threshold, {round_sql('fpr')} AS fpr, {round_sql('tpr')} AS tpr FROM curve")
def roc_curve(spark, d):
    curve = evaluate.roc_curve(tied_items(spark, d), "label", "prob")
    return curve.withColumns({"fpr": rounded("fpr"), "tpr": rounded("tpr")})


@query(
    f"""
    WITH {CURVE_SQL}, ranked AS (SELECT *, row_number() OVER (ORDER BY threshold) - 1 AS rk FROM curve),
    wanted AS (SELECT CAST(i AS INTEGER) AS point, CAST(i AS DOUBLE) / 700 * ((SELECT count(*) FROM curve) - 1) AS spot FROM generate_series(0, 699) g(i)),
    near AS (
        SELECT point, spot, a.threshold AS lo, b.threshold AS hi, a.fpr AS lo_f, b.fpr AS hi_f, a.tpr AS lo_t, b.tpr AS hi_t,
               a.threshold + (spot - floor(spot)) * (b.threshold - a.threshold) AS v
        FROM wanted JOIN ranked a ON a.rk = floor(spot) JOIN ranked b ON b.rk = ceil(spot))
    SELECT point, {round_sql("CASE WHEN hi - v < v - lo THEN hi_f ELSE lo_f END", 5)} AS fpr,
           {round_sql("CASE WHEN hi - v < v - lo THEN hi_t ELSE lo_t END", 5)} AS tpr,
           {round_sql("CASE WHEN hi - v < v - lo THEN hi ELSE lo END", 5)} AS threshold
    FROM near
    """
)
def roc_sample(spark, d):
    return evaluate.roc_sample(evaluate.roc_curve(tied_items(spark, d), "label", "prob"), points=700)


@query(
    f"""
    WITH curve AS ({" UNION ALL ".join(
        f"""SELECT '{c}' AS class, threshold,
            (sum(sum(CAST(o_orderpriority <> '{c}' AS INTEGER))) OVER (ORDER BY threshold DESC))::DOUBLE / (SELECT count(*) FROM orders WHERE o_orderpriority <> '{c}') AS fpr,
            (sum(sum(CAST(o_orderpriority = '{c}' AS INTEGER))) OVER (ORDER BY threshold DESC))::DOUBLE / (SELECT count(*) FROM orders WHERE o_orderpriority = '{c}') AS tpr
            FROM (SELECT o_orderpriority, floor(o_totalprice / {1000 * (i + 1)}) * 1.0::DOUBLE AS threshold FROM orders) GROUP BY threshold"""
        for i, c in enumerate(PRIORITIES))}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY threshold) - 1 AS rk FROM curve),
    wanted AS (
        SELECT class, CAST(i AS INTEGER) AS point, CAST(i AS DOUBLE) / 40 * (n - 1) AS spot
        FROM (SELECT class, count(*) AS n FROM curve GROUP BY 1), generate_series(0, 39) g(i)),
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
def roc_sample_per_class(spark, d):
    scores = [F.floor(F.col("o_totalprice") / (1000 * (i + 1))).cast("double") for i in range(5)]
    rows = table(spark, d, "orders").select("o_orderpriority", F.array(*scores).alias("scores"))
    curves = evaluate.roc_curve_per_class(rows, "o_orderpriority", "scores", PRIORITIES)
    return evaluate.roc_sample(curves, points=40, within=["class"])


# --------------------------------------------- grids, bands, bins, comparison


def grid_rows(spark, d):
    """One result row per line number, with metrics of two classes and features."""
    return table(spark, d, "lineitem").groupBy(F.col("l_linenumber").alias("params_indx")).agg(
        F.concat(F.lit("max_depth="), F.max("l_linenumber").cast("string")).alias("params"),
        F.array(rounded(F.avg("l_discount")), rounded(F.avg("l_tax"))).alias("precision"),
        F.array(rounded(F.avg("l_tax")), rounded(F.avg("l_quantity") / 100)).alias("recall"),
        F.array(rounded(F.avg("l_tax") / 2), rounded(F.avg("l_quantity") / 90)).alias("fscore"),
        F.array(F.lit("quantity"), F.lit("tax")).alias("fnames"),
        F.array(rounded(F.stddev_samp("l_quantity"), 4), rounded(F.stddev_samp("l_tax"), 4)).alias("f_importances"),
    )


@query(
    f"""
    SELECT l_linenumber AS params_indx, 'max_depth=' || l_linenumber AS params, {round_sql("avg(l_tax)")} AS pos_precision,
           {round_sql("avg(l_quantity) / 100")} AS pos_recall, {round_sql("avg(l_quantity) / 90")} AS pos_fscore
    FROM lineitem GROUP BY l_linenumber ORDER BY pos_recall DESC, params_indx
    """
)
def rank_grid_results(spark, d):
    return evaluate.rank_grid_results(grid_rows(spark, d), 2, "recall")


@query(
    f"""
    SELECT l_linenumber AS params_indx, 'quantity' AS fnames, {round_sql("stddev_samp(l_quantity)", 4)} AS f_importances FROM lineitem GROUP BY 1
    UNION ALL SELECT l_linenumber, 'tax', {round_sql("stddev_samp(l_tax)", 4)} FROM lineitem GROUP BY 1
    """
)
def unnest_importance(spark, d):
    return evaluate.unnest_importance(grid_rows(spark, d))


@query(
    f"""
    WITH scored AS (
        SELECT 1 / (1 + exp(-(o_totalprice - 250000) / 100000)) AS prob, CAST(o_orderstatus = 'F' AS INTEGER) AS label FROM orders),
    s AS (
        SELECT CASE WHEN label = 0 OR prob < 0.7 THEN prob END AS p, CAST(prob > 0.5 AS INTEGER) AS said, label FROM scored)
    SELECT CASE WHEN p < 0.2 THEN 'low' WHEN p > 0.8 THEN 'high' ELSE 'mid' END AS pred_type,
           {round_sql("avg(1 - abs(label - said))")} AS prec
    FROM s GROUP BY 1
    """
)
def extreme_precision(spark, d):
    scored = table(spark, d, "orders").select(
        "o_orderkey",
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("o_totalprice") - 250000) / 100000))).alias("prob"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
    )
    shown = F.when((F.col("label") == 0) | (F.col("prob") < 0.7), F.col("prob"))
    results = scored.select(
        "o_orderkey",
        (F.col("prob") > 0.5).cast("int").cast("string").alias("label_predicted"),
        F.array(1 - shown, shown).alias("label_proba_predicted"),
    )
    bands = evaluate.extreme_precision(
        results, scored.select("o_orderkey", "label"), "o_orderkey", "label", 1, 0.2, 0.8
    )
    return bands.withColumn("prec", rounded("prec"))


@query(
    f"""
    WITH s AS (
        SELECT CAST(o_orderkey AS VARCHAR) AS id, round(o_totalprice / 600000, 2) AS prob, CAST(o_orderstatus = 'F' AS INTEGER) AS label FROM orders),
    b AS (SELECT *, CAST(ntile(20) OVER (ORDER BY prob, id) AS INTEGER) AS bin FROM s)
    SELECT id, prob, label, bin, {round_sql("avg(prob) OVER (PARTITION BY bin)")} AS avg_pred_prob,
           {round_sql("avg(label) OVER (PARTITION BY bin)")} AS avg_label
    FROM b
    """
)
def calibration_bins(spark, d):
    rows = table(spark, d, "orders").select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")).alias("id"),
        F.round(F.col("o_totalprice") / 600000, 2).alias("prob"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
    )
    bins = evaluate.calibration_bins(rows, "id", "label", "prob", normalise_ids=True)
    return bins.withColumns({"avg_pred_prob": rounded("avg_pred_prob"), "avg_label": rounded("avg_label")})


def _two_snapshots(spark, d):
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("price"),
        F.dayofyear("o_orderdate").alias("day"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("customer"),
        "o_orderdate",
    )
    cut = F.lit("1998-06-30").cast("timestamp_ntz")
    return orders.where(F.col("o_orderdate") <= cut).drop("o_orderdate"), orders.where(
        F.col("o_orderdate") > cut
    ).drop("o_orderdate")


def _compare_sql() -> str:
    parts = []
    for c in ("price", "day", "customer"):
        sides = []
        for side, test in (("a", "<="), ("b", ">")):
            f = f"FILTER (o_orderdate {test} TIMESTAMP '1998-06-30')"
            sides.append(
                f"count({c}) {f} AS count_{side}, count(*) {f} - count({c}) {f} AS nulls_{side}, {round_sql(f'avg({c}) {f}', 4)} AS mean_{side}, "
                f"{round_sql(f'stddev_samp({c}) {f}', 4)} AS stddev_{side}, {round_sql(f'min({c}) {f}', 4)} AS min_{side}, {round_sql(f'max({c}) {f}', 4)} AS max_{side}"
            )
        diff = round_sql(
            f"avg({c}) FILTER (o_orderdate > TIMESTAMP '1998-06-30') - avg({c}) FILTER (o_orderdate <= TIMESTAMP '1998-06-30')", 4
        )
        parts.append(f"SELECT '{c}' AS col_name, {', '.join(sides)}, {diff} AS mean_diff FROM o")
    return (
        "o AS (SELECT o_totalprice AS price, dayofyear(o_orderdate) AS day, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS customer, o_orderdate FROM orders), "
        "compared AS (" + " UNION ALL ".join(parts) + ")"
    )


def _compared(spark, d):
    compared = evaluate.dataset_compare(*_two_snapshots(spark, d), exclude=["id"])
    doubles = [c for c, t in compared.dtypes if t == "double"]
    return compared.withColumns({c: rounded(c, 4) for c in doubles})


@query(f"WITH {_compare_sql()} SELECT * FROM compared")
def dataset_compare(spark, d):
    return _compared(spark, d)


@query(
    f"""
    WITH {_compare_sql()}, importance AS (
        SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'price' WHEN '2-HIGH' THEN 'customer' ELSE o_orderpriority END AS f, count(*)::DOUBLE AS w
        FROM orders GROUP BY 1)
    SELECT compared.*, w AS f_importances FROM compared JOIN importance ON f = col_name ORDER BY w DESC
    """
)
def drift_by_importance(spark, d):
    priority = F.col("o_orderpriority")
    feature = F.when(priority == "1-URGENT", "price").when(priority == "2-HIGH", "customer").otherwise(priority)
    importance = table(spark, d, "orders").groupBy(feature.alias("fnames")).agg(
        F.count("*").cast("double").alias("f_importances")
    )
    return evaluate.drift_by_importance(_compared(spark, d), importance)
