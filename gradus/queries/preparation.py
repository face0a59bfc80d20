"""Data preparation: duplicates, statistics, normalisation, splits, collinearity."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradus.functions import unnest_together
from gradus.operators import prep, split, vif
from gradus.queries.registry import query, round_sql, rounded, table


def keyed_items(spark, d):
    """Order lines with a text key that is often duplicated."""
    return table(spark, d, "lineitem").withColumn("pk1", F.concat_ws("-", "l_orderkey", "l_linenumber"))


@query(
    """
    WITH keyed AS (SELECT nullif(l_orderkey || '-' || l_linenumber, '1-1') AS pk1, l_partkey, l_quantity, l_shipdate FROM lineitem)
    SELECT pk1, l_partkey, l_quantity, l_shipdate FROM keyed
    WHERE pk1 IS NULL OR pk1 NOT IN (SELECT pk1 FROM keyed WHERE pk1 IS NOT NULL GROUP BY pk1 HAVING count(*) > 1)
    """
)
def drop_duplicate_keys(spark, d):
    keyed = keyed_items(spark, d).select(
        F.nullif("pk1", F.lit("1-1")).alias("pk1"), "l_partkey", "l_quantity", "l_shipdate"
    )
    return prep.drop_duplicate_keys(keyed, "pk1")


@query(
    """
    SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (
        SELECT count(*) AS n FROM (SELECT nullif(l_suppkey, 7) AS k, l_partkey FROM lineitem) GROUP BY k, l_partkey)
    """
)
def duplicate_row_count(spark, d):
    items = table(spark, d, "lineitem").select(
        F.struct(F.nullif("l_suppkey", F.lit(7)).alias("s"), F.col("l_partkey").alias("p")).alias("key")
    )
    return prep.duplicate_row_count(items, "key")


@query(
    """
    SELECT l_orderkey, l_linenumber, CAST(l_linestatus = 'O' AS INTEGER)::DOUBLE AS is_open,
           CAST(nullif(l_returnflag, 'N') = 'R' AS INTEGER)::DOUBLE AS returned
    FROM lineitem
    """
)
def booleans_to_double(spark, d):
    flags = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_linestatus") == "O").alias("is_open"),
        (F.nullif("l_returnflag", F.lit("N")) == "R").alias("returned"),
    )
    return prep.booleans_to_double(flags)


def gappy_items(spark, d):
    """Numeric features with nulls, a constant, an all-null and a boolean column."""
    return table(spark, d, "lineitem").select(
        F.when(F.col("l_linenumber") != 1, F.col("l_quantity")).alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_tax").alias("tax"),
        (F.col("l_linestatus") == "O").alias("is_open"),
        F.lit(1.0).alias("fixed"),
        F.lit(None).cast("double").alias("absent"),
    )


GAPPY_SQL = """
    gappy AS (
        SELECT CASE WHEN l_linenumber <> 1 THEN l_quantity END AS quantity, l_extendedprice AS price, l_tax AS tax,
               CAST(l_linestatus = 'O' AS INTEGER)::DOUBLE AS is_open, 1.0::DOUBLE AS fixed, NULL::DOUBLE AS absent
        FROM lineitem)"""

STATS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {round_sql(f'avg({c})', 4)} AS avg, {round_sql(f'stddev_samp({c})', 4)} AS stddev FROM gappy"
    for c in ("quantity", "price", "tax", "is_open", "fixed", "absent")
)


def _shown(stats):
    return stats.select("column_name", rounded("avg", 4).alias("avg"), rounded("stddev", 4).alias("stddev"))


@query(f"WITH {GAPPY_SQL} {STATS_SQL}")
def column_stats(spark, d):
    items = gappy_items(spark, d)
    return _shown(prep.column_stats(items, items.columns))


@query(f"WITH {GAPPY_SQL} SELECT * FROM ({STATS_SQL}) WHERE stddev > 0")
def nonzero_variance(spark, d):
    items = gappy_items(spark, d)
    return _shown(prep.nonzero_variance(prep.column_stats(items, items.columns)))


def order_features(spark, d):
    """Orders with a nullable, a boolean, a constant and a plain feature, and a label."""
    status = F.col("o_orderstatus")
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price"),
        F.dayofyear("o_orderdate").alias("day"),
        (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        F.lit(3).alias("fixed"),
        F.when(status != "P", (status == "F").cast("int")).alias("label"),
    )


ORDER_FEATURES_SQL = """
    features AS (
        SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price,
               dayofyear(o_orderdate)::DOUBLE AS day, CAST(o_orderpriority = '1-URGENT' AS INTEGER)::DOUBLE AS urgent,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderstatus = 'F' AS INTEGER) END AS label
        FROM orders)"""


def _long_vectors(df):
    rows = unnest_together(
        df, ["o_orderkey", "label"],
        feat_name=F.col("feat_name_vect"), feat=F.col("feat_vect"), feat_normalized=F.col("feat_vect_normalized"),
    )
    return rows.withColumn("feat_normalized", rounded("feat_normalized"))


def _normalised_sql(stats_from: str) -> str:
    stats = ", ".join(
        f"avg({c}) AS avg_{c}, stddev_samp({c}) AS sd_{c}" for c in ("price", "day", "urgent")
    )
    rows = " UNION ALL ".join(
        f"SELECT o_orderkey, label, '{c}' AS feat_name, {c} AS feat, "
        f"{round_sql(f'(coalesce({c}, avg_{c}) - avg_{c}) / sd_{c}')} AS feat_normalized FROM features, stats"
        for c in ("price", "day", "urgent")
    )
    return f"WITH {ORDER_FEATURES_SQL}, stats AS (SELECT {stats} FROM {stats_from}) {rows}"


@query(
    _normalised_sql("features")
    + " UNION ALL SELECT o_orderkey, label, 'constant_term', 1.0::DOUBLE, 1.0::DOUBLE FROM features"
)
def impute_normalize(spark, d):
    return _long_vectors(
        prep.impute_normalize(order_features(spark, d), "o_orderkey", "label", constant_term=True)
    )


@query(_normalised_sql("(SELECT * FROM features WHERE label IS NOT NULL)"))
def scale_with(spark, d):
    orders = order_features(spark, d)
    known = orders.where(F.col("label").isNotNull())
    stats = prep.FeatureStats.fit(known, prep.feature_names(known, ["o_orderkey", "label"]))
    return _long_vectors(prep.scale_with(orders, stats, "o_orderkey", "label"))


@query(
    f"""
    WITH {ORDER_FEATURES_SQL}
    SELECT o_orderkey, 'day' AS feat_name, day AS feat FROM features
    UNION ALL SELECT o_orderkey, 'urgent', urgent FROM features
    """
)
def apply_mask(spark, d):
    vectors = prep.impute_normalize(order_features(spark, d), "o_orderkey", "label")
    masked = prep.apply_mask(vectors, [1, 0, 1])
    return unnest_together(masked, ["o_orderkey"], feat_name=F.col("feat_name_vect"), feat=F.col("feat_vect"))


# -------------------------------------------------------------------- splits

UNIFORM_SQL = "('0x' || substr(md5('{seed}:' || {key}), 1, 8))::UBIGINT / 4294967296.0::DOUBLE"


@query(
    f"""
    WITH {ORDER_FEATURES_SQL}
    SELECT o_orderkey, label, CASE WHEN {UNIFORM_SQL.format(seed=42, key="o_orderkey")} <= 0.8 THEN 'train' ELSE 'test' END AS part
    FROM features WHERE label IS NOT NULL
    """
)
def random_split(spark, d):
    train, test = split.random_split(order_features(spark, d).select("o_orderkey", "label"), "o_orderkey", "label", 0.8)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    " UNION ALL ".join(
        f"SELECT {i} AS sample, o_orderkey FROM orders WHERE floor({UNIFORM_SQL.format(seed=f'42-{i}', key='o_orderkey')} * 3) <> {i - 1}"
        for i in (1, 2, 3)
    )
)
def leave_fold_samples(spark, d):
    samples = split.leave_fold_samples(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 3)
    numbered = [s.select(F.lit(i).alias("sample"), "o_orderkey") for i, s in enumerate(samples, start=1)]
    return numbered[0].unionByName(numbered[1]).unionByName(numbered[2])


def termed_orders(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").cast("string").alias("academic_period"),
        F.nullif("o_custkey", F.lit(5)).alias("person_uid"),
        F.col("o_orderpriority").alias("course"),
    )


TERMED_SQL = """
    termed AS (
        SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS academic_period, nullif(o_custkey, 5) AS person_uid,
               o_orderpriority AS course FROM orders),
    counted AS (
        SELECT academic_period, person_uid, sum(n) OVER (PARTITION BY academic_period ORDER BY person_uid NULLS LAST) AS cume,
               sum(n) OVER (PARTITION BY academic_period) AS total
        FROM (SELECT academic_period, person_uid, count(*) AS n FROM termed GROUP BY 1, 2)),
    split AS (
        SELECT t.*, CASE WHEN cume < total * 0.8::DOUBLE THEN 1 ELSE 0 END AS train_set
        FROM termed t LEFT JOIN counted c ON t.person_uid = c.person_uid AND t.academic_period = c.academic_period)"""


@query(f"WITH {TERMED_SQL} SELECT * FROM split")
def group_cumulative_split(spark, d):
    return split.group_cumulative_split(termed_orders(spark, d), "academic_period", "person_uid")


@query(
    f"""
    WITH {TERMED_SQL}
    SELECT course, academic_period, count(*) FILTER (train_set = 1) AS train_rows,
           count(*) FILTER (train_set = 0) AS test_rows
    FROM split GROUP BY 1, 2
    """
)
def split_balance(spark, d):
    marked = split.group_cumulative_split(termed_orders(spark, d), "academic_period", "person_uid")
    return split.split_balance(marked, ["course", "academic_period"])


@query(
    f"""
    WITH {ORDER_FEATURES_SQL}, drawn AS (
        SELECT o_orderkey, {UNIFORM_SQL.format(seed=42, key="o_orderkey")} AS u FROM features WHERE label IS NOT NULL)
    SELECT o_orderkey, 'train' AS part FROM drawn WHERE u <= 0.7
    UNION ALL
    SELECT o_orderkey, 'test' FROM (SELECT *, row_number() OVER (ORDER BY u, o_orderkey) AS rn FROM drawn WHERE u > 0.7)
    WHERE rn <= (SELECT CAST(floor(count(*) * 0.2) AS BIGINT) FROM drawn)
    """
)
def random_or_column_split(spark, d):
    labelled = order_features(spark, d).select("o_orderkey", "label")
    train, test = split.random_or_column_split(labelled, "o_orderkey", "label", 0.7, "")
    return train.select("o_orderkey", F.lit("train").alias("part")).unionByName(
        test.select("o_orderkey", F.lit("test").alias("part"))
    )


@query(
    f"""
    WITH {TERMED_SQL}
    SELECT o_orderkey, course, academic_period, person_uid, CASE train_set WHEN 1 THEN 'train' ELSE 'test' END AS part
    FROM split WHERE person_uid IS NOT NULL
    """
)
def column_split(spark, d):
    marked = split.group_cumulative_split(termed_orders(spark, d), "academic_period", "person_uid")
    train, test = split.random_or_column_split(marked, "o_orderkey", "person_uid", split_col="train_set")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


# ------------------------------------------------------------ null handling


@query(f"WITH {GAPPY_SQL} SELECT quantity, price, tax, CAST(is_open AS INTEGER) = 1 AS is_open, fixed FROM gappy")
def drop_all_null_columns(spark, d):
    return prep.drop_all_null_columns(gappy_items(spark, d))


@query(
    f"""
    WITH gaps AS (
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority,
               CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS price FROM orders)
    SELECT o_orderkey,
           coalesce(priority, (SELECT priority FROM gaps WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS priority,
           {round_sql("coalesce(price, (SELECT avg(price) FROM gaps))", 4)} AS price
    FROM gaps
    """
)
def impute_mean_or_mode(spark, d):
    gaps = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("price"),
    )
    filled = prep.impute_mean_or_mode(gaps, ["priority", "price"])
    return filled.withColumn("price", rounded("price", 4))


# -------------------------------------------------------------- collinearity


def collinear_items(spark, d):
    """Revenue beside price is nearly collinear; quantity is not."""
    return table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("pk1"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
    )


COLLINEAR_SQL = """
    x AS (SELECT l_extendedprice AS price, l_quantity AS quantity, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem),
    r AS (SELECT corr(price, quantity) AS pq, corr(price, revenue) AS pr, corr(quantity, revenue) AS qr FROM x),
    first AS (
        SELECT unnest(['price', 'quantity', 'revenue']) AS feature,
               unnest([(1 - qr * qr) / det, (1 - pr * pr) / det, (1 - pq * pq) / det]) AS vif
        FROM (SELECT *, 1 + 2 * pq * pr * qr - pq * pq - pr * pr - qr * qr AS det FROM r))"""


@query(f"WITH {COLLINEAR_SQL} SELECT feature, {round_sql('vif', 4)} AS vif FROM first")
def vif_scores(spark, d):
    scores = vif.vif_scores(collinear_items(spark, d), ["price", "quantity", "revenue"])
    return scores.withColumn("vif", rounded("vif", 4))


# Of the two features left after the first step both have the same factor, and
# the first in order is recorded.
VIF_SQL = f"""
    WITH {COLLINEAR_SQL}, worst AS (SELECT arg_max(feature, vif) AS f, max(vif) AS v FROM first),
    second AS (
        SELECT CASE f WHEN 'price' THEN 'quantity' ELSE 'price' END AS f,
               1 / (1 - pow(CASE f WHEN 'price' THEN qr WHEN 'revenue' THEN pq ELSE pr END, 2)) AS v
        FROM worst, r)"""


@query(
    f"""
    {VIF_SQL}
    SELECT 0 AS step, f AS feature_w_max_vif, {round_sql("v", 4)} AS vif, v > 10 AS discarded FROM worst
    UNION ALL SELECT 1, f, {round_sql("v", 4)}, v > 10 FROM second
    """
)
def vif_select(spark, d):
    found = vif.vif_select(collinear_items(spark, d), ["price", "quantity", "revenue"])
    return found.withColumn("vif", rounded("vif", 4))


@query(
    f"""
    {VIF_SQL}
    SELECT 0 AS step, f AS feature_w_max_vif, {round_sql("v", 4)} AS vif, v > 10 AS discarded FROM worst
    """
)
def vif_select_wide(spark, d):
    found = vif.vif_select_wide(collinear_items(spark, d), "pk1", steps=1)
    return found.withColumn("vif", rounded("vif", 4))


@query(
    f"""
    {VIF_SQL}
    SELECT feature, CASE WHEN feature = (SELECT f FROM worst WHERE v > 10) THEN 0 ELSE 1 END AS mask FROM first
    """
)
def vif_mask(spark, d):
    items = collinear_items(spark, d)
    names = ["price", "quantity", "revenue"]
    steps = [tuple(r) for r in vif.vif_select(items, names).collect()]
    return spark.createDataFrame(list(zip(names, vif.vif_mask(names, steps))), "feature string, mask int")
