"""The clause-level operators: scans, predicates, joins, aggregates, windows, functions."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from gradus.functions import (
    array_length,
    drop_at,
    fixed_text,
    guarded_ratio,
    hash_uniform,
    keep_where,
    schema_part,
    table_part,
    unnest_together,
    year_digits,
)
from gradus.operators.assemble import select_feature_columns
from gradus.operators.ranking import global_row_number, running_totals
from gradus.queries.registry import query, round_sql, rounded, table
from gradus.session import broadcast_if_small, shared_folder, with_row
from gradus.sources import append_parts, last_builds
from gradus.sources.tables import export_csv as write_csv
from gradus.sources.tables import replace_table as write_table

# ------------------------------------------------------------ scans, append


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def table_scan(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    """
    SELECT 'customer' AS side, c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL
    SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier
    """
)
def append_rows(spark, d):
    customer = table(spark, d, "customer").select(
        F.lit("customer").alias("side"),
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    supplier = table(spark, d, "supplier").select(
        F.lit("supplier").alias("side"),
        F.col("s_suppkey").alias("key"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    return append_parts([customer, supplier])


@query("SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal > 0")
def replace_table(spark, d):
    """Read back after a second write replaced the first."""
    target = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    customer = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    write_table(customer, target)
    write_table(customer.where(F.col("c_acctbal") > 0), target)
    return spark.read.parquet(target)


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def export_csv(spark, d):
    """Read back from the files written."""
    target = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    write_csv(orders, target)
    return spark.read.schema(orders.schema).option("header", True).csv(target)


@query(
    """
    SELECT l_orderkey, l_linenumber, CAST(CAST(round(l_extendedprice / 7, 2) AS DECIMAL(38, 5)) AS VARCHAR) AS price,
           CAST(CAST(l_tax AS DECIMAL(38, 5)) AS VARCHAR) AS tax
    FROM lineitem
    """
)
def fixed_width_text(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fixed_text(rounded(F.col("l_extendedprice") / 7, 2)).alias("price"),
        fixed_text(F.col("l_tax")).alias("tax"),
    )


@query(
    """
    SELECT n, count(*) AS line_items FROM (SELECT unnest(generate_series(1, l_linenumber)) AS n FROM lineitem)
    GROUP BY n
    """
)
def inline_series(spark, d):
    series = table(spark, d, "lineitem").select(F.explode(F.sequence(F.lit(1), F.col("l_linenumber"))).alias("n"))
    return series.groupBy(F.col("n").cast("bigint").alias("n")).agg(F.count("*").alias("line_items"))


def build_log(spark, d):
    """Events read as a log of table builds."""
    return table(spark, d, "events").select(
        F.concat(F.lit("features."), "event_type").alias("table_name"),
        F.when(F.col("value") >= 10, "CREATE").otherwise("ALTER").alias("action"),
        F.lit("TABLE").alias("subtype"),
        "ts",
    )


BUILD_LOG_SQL = """
    build_log AS (
        SELECT 'features.' || event_type AS table_name,
               CASE WHEN value >= 10 THEN 'CREATE' ELSE 'ALTER' END AS action, 'TABLE' AS subtype, ts
        FROM events)"""


@query(
    f"""
    WITH {BUILD_LOG_SQL}
    SELECT table_name, last_build FROM (
        SELECT table_name, CAST(ts AS DATE) AS last_build,
               row_number() OVER (PARTITION BY table_name ORDER BY ts DESC) AS rn
        FROM build_log WHERE action = 'CREATE' AND subtype = 'TABLE')
    WHERE rn = 1
    """
)
def last_build(spark, d):
    return last_builds(build_log(spark, d))


# ------------------------------------------------- projections, predicates


@query("SELECT *, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem")
def project_alias(spark, d):
    return table(spark, d, "lineitem").withColumn("revenue", F.col("l_extendedprice") * (1 - F.col("l_discount")))


@query("SELECT l_linenumber, l_quantity, l_discount, l_tax FROM lineitem")
def select_by_rules(spark, d):
    items = table(spark, d, "lineitem")
    chosen = select_feature_columns(
        items.columns,
        exclude=["l_extendedprice"],
        exclude_regex=[r"(?<!line)key$", r"l_ship.+", r"l_(?!linenumber)(return|line).+"],
    )
    return items.select(*chosen)


@query(
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
    WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority NOT IN ('5-LOW')
      AND o_totalprice >= 100000 AND o_totalprice < 300000
    """
)
def filter_predicates(spark, d):
    return table(spark, d, "orders").where(
        F.col("o_orderstatus").isin("F", "P")
        & ~F.col("o_orderpriority").isin("5-LOW")
        & (F.col("o_totalprice") >= 100000)
        & (F.col("o_totalprice") < 300000)
    ).select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")


@query(
    """
    SELECT doc_id, lang, n_chars FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL
    """
)
def null_predicates(spark, d):
    labelled = table(spark, d, "documents").select("doc_id", "lang", "n_chars").join(
        table(spark, d, "labels"), "doc_id", "left"
    )
    return labelled.where(F.col("quality").isNull()).select("doc_id", "lang", "n_chars")


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_discount < 0.02 THEN 'low' WHEN l_discount > 0.08 THEN 'high' ELSE 'mid' END AS band,
           CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END AS returned
    FROM lineitem
    """
)
def case_expressions(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_discount") < 0.02, "low").when(F.col("l_discount") > 0.08, "high").otherwise("mid").alias("band"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned"),
    )


@query(
    f"""
    SELECT o_orderpriority, {round_sql("sum(o_totalprice) / (SELECT sum(o_totalprice) FROM orders)")} AS share
    FROM orders GROUP BY o_orderpriority
    """
)
def scalar_subquery(spark, d):
    by = table(spark, d, "orders").groupBy("o_orderpriority").agg(F.sum("o_totalprice").alias("s"))
    total = by.agg(F.sum("s").alias("total"))
    return with_row(by, total).select("o_orderpriority", rounded(F.col("s") / F.col("total")).alias("share"))


@query(
    """
    WITH spend AS (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey)
    SELECT c_mktsegment, count(*) AS big_customers
    FROM spend JOIN customer ON o_custkey = c_custkey
    WHERE total > (SELECT avg(total) FROM spend)
    GROUP BY c_mktsegment
    """
)
def common_table_expression(spark, d):
    spend = table(spark, d, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    mean = spend.agg(F.avg("total").alias("mean"))
    big = with_row(spend, mean).where(F.col("total") > F.col("mean"))
    customer = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return big.join(customer, big["o_custkey"] == customer["c_custkey"]).groupBy("c_mktsegment").agg(
        F.count("*").alias("big_customers")
    )


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CAST(CAST(l_linestatus = 'O' AS INTEGER) AS DOUBLE) AS open_flag,
           CAST(CAST(year(l_shipdate) AS VARCHAR) AS INTEGER) AS ship_year,
           CAST(l_partkey AS VARCHAR) AS part_text
    FROM lineitem
    """
)
def cast_chains(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_linestatus") == "O").cast("int").cast("double").alias("open_flag"),
        F.year("l_shipdate").cast("string").cast("int").alias("ship_year"),
        F.col("l_partkey").cast("string").alias("part_text"),
    )


@query(
    f"""
    SELECT l_suppkey, {round_sql(
        "sum(l_tax) * 1.0 / (count(*) FILTER (l_discount > 0.09) + CAST(0.001 AS DOUBLE) * CAST((count(*) FILTER (l_discount > 0.09)) = 0 AS INTEGER))", 4
    )} AS tax_per_deep_discount
    FROM lineitem GROUP BY l_suppkey
    """
)
def zero_guard(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        rounded(
            guarded_ratio(F.sum("l_tax"), F.count(F.when(F.col("l_discount") > 0.09, 1))), 4
        ).alias("tax_per_deep_discount")
    )


@query(
    """
    SELECT o_orderkey, unnest(['status', 'priority']) AS name, unnest([o_orderstatus, o_orderpriority]) AS value
    FROM orders
    """
)
def unnest_arrays(spark, d):
    return unnest_together(
        table(spark, d, "orders"),
        ["o_orderkey"],
        name=F.array(F.lit("status"), F.lit("priority")),
        value=F.array("o_orderstatus", "o_orderpriority"),
    )


# -------------------------------------------------------------------- joins


@query(
    """
    SELECT l_orderkey, l_linenumber, o_orderdate, o_custkey
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus = 'F' AND l_returnflag IN ('A', 'R')
    """
)
def inner_join(spark, d):
    items = table(spark, d, "lineitem").where(F.col("l_returnflag").isin("A", "R")).select("l_orderkey", "l_linenumber")
    orders = table(spark, d, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderdate", "o_custkey")
    return items.join(orders, items["l_orderkey"] == orders["o_orderkey"]).drop("o_orderkey")


@query(
    """
    SELECT o_orderkey, o_custkey, n FROM orders
    LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) ON o_custkey = user_id
    """
)
def left_join(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    counts = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return orders.join(counts, orders["o_custkey"] == counts["user_id"], "left").drop("user_id")


@query(
    """
    SELECT c_custkey, c_name, last_urgent
    FROM customer LEFT JOIN (
        SELECT o_custkey, max(o_orderkey) AS last_urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey
    ) ON c_custkey = o_custkey
    """
)
def left_join_filtered_right(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_name")
    urgent = table(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT").groupBy("o_custkey").agg(
        F.max("o_orderkey").alias("last_urgent")
    )
    return customer.join(urgent, customer["c_custkey"] == urgent["o_custkey"], "left").drop("o_custkey")


@query(
    """
    SELECT o_orderkey, spend
    FROM (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) || '.0' AS id, CAST(year(o_orderdate) AS VARCHAR) AS term FROM orders)
    JOIN (SELECT CAST(l_suppkey AS VARCHAR) AS sid, CAST(year(l_shipdate) AS VARCHAR) AS aid_year, sum(l_quantity) AS spend
          FROM lineitem GROUP BY 1, 2)
      ON split_part(id, '.', 1) = sid AND substr(term, 3, 2) = substr(aid_year, 3, 2)
    """
)
def computed_key_join(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        F.substring_index(F.concat(F.col("o_custkey").cast("string"), F.lit(".0")), ".", 1).alias("id"),
        year_digits(F.year("o_orderdate")).alias("yy"),
    )
    sums = table(spark, d, "lineitem").groupBy(
        F.col("l_suppkey").cast("string").alias("id"), year_digits(F.year("l_shipdate")).alias("yy")
    ).agg(F.sum("l_quantity").alias("spend"))
    return orders.join(sums, ["id", "yy"]).select("o_orderkey", "spend")


@query(
    """
    SELECT c_custkey, c_mktsegment FROM customer
    LEFT JOIN (SELECT DISTINCT user_id FROM events) ON c_custkey = user_id WHERE user_id IS NULL
    """
)
def left_anti_join(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    users = table(spark, d, "events").select(F.col("user_id").alias("c_custkey"))
    return customer.join(users, "c_custkey", "left_anti")


@query(
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount >= 0.1)
    """
)
def semi_join(spark, d):
    deep = table(spark, d, "lineitem").where(F.col("l_discount") >= 0.1).select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").join(deep, "o_orderkey", "left_semi")


@query(
    f"""
    SELECT c_custkey, {round_sql("(c_acctbal - m) / s")} AS standard_score
    FROM customer, (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS s FROM customer)
    """
)
def one_row_join(spark, d):
    customer = table(spark, d, "customer")
    stats = customer.agg(F.avg("c_acctbal").alias("m"), F.stddev_samp("c_acctbal").alias("s"))
    return with_row(customer, stats).select(
        "c_custkey", rounded((F.col("c_acctbal") - F.col("m")) / F.col("s")).alias("standard_score")
    )


# --------------------------------------------------------------- aggregates


@query(
    f"""
    SELECT l_returnflag, l_linestatus, count(*) AS n, {round_sql("sum(l_quantity)", 2)} AS sum_qty,
           {round_sql("avg(l_extendedprice)", 4)} AS avg_price, max(l_shipdate) AS last_ship,
           {round_sql("stddev_samp(l_quantity)")} AS sd_qty
    FROM lineitem GROUP BY 1, 2
    """
)
def grouped_aggregates(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        rounded(F.sum("l_quantity"), 2).alias("sum_qty"),
        rounded(F.avg("l_extendedprice"), 4).alias("avg_price"),
        F.max("l_shipdate").alias("last_ship"),
        rounded(F.stddev_samp("l_quantity")).alias("sd_qty"),
    )


@query(
    """
    SELECT user_id, max(CASE event_type WHEN 'click' THEN value END) AS click,
           max(CASE event_type WHEN 'view' THEN value END) AS view_,
           max(CASE event_type WHEN 'purchase' THEN value END) AS purchase
    FROM events GROUP BY user_id
    """
)
def conditional_pivot(spark, d):
    kinds = {"click": "click", "view_": "view", "purchase": "purchase"}
    return table(spark, d, "events").groupBy("user_id").agg(
        *[F.max(F.when(F.col("event_type") == kind, F.col("value"))).alias(name) for name, kind in kinds.items()]
    )


@query(
    """
    SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_nationkey) AS nations
    FROM nation JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) ON c_nationkey = n_nationkey
    GROUP BY n_regionkey
    """
)
def ordered_array(spark, d):
    nation = table(spark, d, "nation")
    present = table(spark, d, "customer").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    pairs = F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))
    return nation.join(present, "n_nationkey").groupBy("n_regionkey").agg(
        F.array_join(F.transform(pairs, lambda p: p["n_name"]), ",").alias("nations")
    )


@query("SELECT o_custkey, o_orderstatus FROM orders GROUP BY 1, 2")
def distinct_by_group(spark, d):
    return table(spark, d, "orders").select("o_custkey", "o_orderstatus").distinct()


@query(
    f"""
    SELECT user_id, {round_sql("max(day_total)", 4)} AS best_day FROM (
        SELECT user_id, CAST(ts AS DATE) AS day, sum(CASE WHEN event_type IN ('click', 'view') THEN value END) AS day_total
        FROM events GROUP BY 1, 2)
    GROUP BY user_id
    """
)
def two_level_aggregate(spark, d):
    wanted = F.when(F.col("event_type").isin("click", "view"), F.col("value"))
    per_day = table(spark, d, "events").groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.sum(wanted).alias("day_total")
    )
    return per_day.groupBy("user_id").agg(rounded(F.max("day_total"), 4).alias("best_day"))


# ------------------------------------------------------------------ windows


@query(
    """
    SELECT event_type, event_id, ts FROM (
        SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """
)
def latest_row(spark, d):
    newest = F.max(F.struct("ts", "event_id"))
    return table(spark, d, "events").groupBy("event_type").agg(newest.alias("m")).select(
        "event_type", "m.event_id", "m.ts"
    )


@query(
    """
    SELECT year, o_custkey, n, CAST(sum(n) OVER (PARTITION BY year ORDER BY o_custkey) AS BIGINT) AS running
    FROM (SELECT year(o_orderdate) AS year, o_custkey, count(*) AS n FROM orders GROUP BY 1, 2)
    """
)
def running_sum(spark, d):
    counts = table(spark, d, "orders").groupBy(F.year("o_orderdate").cast("bigint").alias("year"), "o_custkey").agg(
        F.count("*").alias("n")
    )
    return running_totals(counts, {"running": F.col("n")}, [F.col("o_custkey")], within=["year"])


@query(
    """
    SELECT c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn
    FROM customer
    """
)
def row_number_in_group(spark, d):
    rows = table(spark, d, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    numbered = running_totals(
        rows, {"rn": F.lit(1)}, [F.col("c_acctbal").desc(), F.col("c_custkey")], within=["c_mktsegment"]
    )
    return numbered.drop("c_acctbal")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS price_rank FROM orders")
def whole_table_rank(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return global_row_number(rows, [F.col("o_totalprice"), F.col("o_orderkey")], "price_rank").drop("o_totalprice")


@query(
    f"""
    SELECT p_brand, {round_sql("cume_dist() OVER (ORDER BY abs(spread))")} AS relative_rank
    FROM (SELECT p_brand, avg(p_retailprice) - 1000 AS spread FROM part GROUP BY p_brand)
    """
)
def cumulative_distribution(spark, d):
    spread = table(spark, d, "part").groupBy("p_brand").agg((F.avg("p_retailprice") - 1000).alias("spread"))
    rank = F.cume_dist().over(Window.orderBy(F.abs("spread")))
    return spread.select("p_brand", rounded(rank).alias("relative_rank"))


@query(
    f"""
    SELECT o_orderkey, {round_sql("avg(o_totalprice) OVER (PARTITION BY o_orderpriority)", 4)} AS group_mean FROM orders
    """
)
def group_mean_on_rows(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    means = orders.groupBy("o_orderpriority").agg(rounded(F.avg("o_totalprice"), 4).alias("group_mean"))
    return orders.join(broadcast_if_small(means), "o_orderpriority").select("o_orderkey", "group_mean")


# -------------------------------------------------------- sorts, set algebra


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey")
def sorted_rows(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal").orderBy(
        F.col("s_acctbal").desc(), "s_suppkey"
    )


@query(
    """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
    """
)
def top_k(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc(), "o_orderkey"
    ).limit(20)


@query(
    """
    SELECT 'const' AS feat_name, o_orderkey, 1.0::DOUBLE AS feat FROM orders
    UNION ALL SELECT 'price', o_orderkey, o_totalprice FROM orders
    """
)
def union_all(spark, d):
    orders = table(spark, d, "orders")
    both = F.array(
        F.struct(F.lit("const").alias("feat_name"), F.lit(1.0).alias("feat")),
        F.struct(F.lit("price").alias("feat_name"), F.col("o_totalprice").alias("feat")),
    )
    return orders.select("o_orderkey", F.inline(both))


@query(
    """
    SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate <= TIMESTAMP '1998-06-30'
    UNION
    SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate <= TIMESTAMP '1999-12-31'
    """
)
def union_distinct(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderdate")

    def upto(day):
        kept = orders.where(F.col("o_orderdate") <= F.lit(day).cast("timestamp_ntz"))
        return kept.select("o_custkey", "o_orderstatus")

    return upto("1998-06-30").union(upto("1999-12-31")).distinct()


# ---------------------------------------------------------- scalar functions


@query(
    """
    SELECT s_suppkey, 'sup.' || s_name AS full_name, split_part('sup.' || s_name, '.', 1) AS schema_name,
           split_part('sup.' || s_name, '.', 2) AS table_name, strpos(s_name, '#') AS hash_at,
           substring(s_name, 1, 4) AS stem, replace(s_name, '#', '_') AS safe_name,
           regexp_replace(s_name, '[0-9]+', '', 'g') AS letters, trim('  ' || s_name || ' ') AS trimmed
    FROM supplier
    """
)
def string_functions(spark, d):
    name = F.col("s_name")
    full = F.concat(F.lit("sup."), name)
    return table(spark, d, "supplier").select(
        "s_suppkey",
        full.alias("full_name"),
        schema_part(full).alias("schema_name"),
        table_part(full).alias("table_name"),
        F.instr(name, "#").cast("bigint").alias("hash_at"),
        F.substring(name, 1, 4).alias("stem"),
        F.replace(name, F.lit("#"), F.lit("_")).alias("safe_name"),
        F.regexp_replace(name, "[0-9]+", "").alias("letters"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
    )


@query(
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%d_%b_%Y') AS stamp,
           lower(strftime(o_orderdate, '%d_%b_%Y')) AS lower_stamp,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS BIGINT) AS age_days
    FROM orders
    """
)
def date_functions(spark, d):
    day = F.col("o_orderdate").cast("date")
    stamp = F.date_format("o_orderdate", "dd_MMM_yyyy")
    return table(spark, d, "orders").select(
        "o_orderkey",
        day.alias("day"),
        stamp.alias("stamp"),
        F.lower(stamp).alias("lower_stamp"),
        F.datediff(F.lit("2002-01-01").cast("date"), day).cast("bigint").alias("age_days"),
    )


@query(
    f"""
    SELECT c_custkey, {round_sql("c_acctbal / 3", 2)} AS third, abs(c_acctbal) AS size,
           {round_sql("pow(c_acctbal / 1000, 2)")} AS square, CAST(floor(c_acctbal / 7) AS BIGINT) AS whole,
           coalesce(nullif(c_nationkey, 3), -1) AS nation
    FROM customer
    """
)
def math_functions(spark, d):
    balance = F.col("c_acctbal")
    return table(spark, d, "customer").select(
        "c_custkey",
        rounded(balance / 3, 2).alias("third"),
        F.abs(balance).alias("size"),
        rounded(F.pow(balance / 1000, F.lit(2.0))).alias("square"),
        F.floor(balance / 7).alias("whole"),
        F.coalesce(F.nullif("c_nationkey", F.lit(3)), F.lit(-1)).alias("nation"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, CAST(q AS VARCHAR) AS second_, array_to_string([q, l, p], ',') AS joined,
           array_to_string([q, p], ',') AS without_second, array_to_string([l, p], ',') AS masked, 3 AS length
    FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS q, CAST(l_suppkey AS VARCHAR) AS l,
                 CAST(l_linenumber AS VARCHAR) AS p FROM lineitem)
    """
)
def array_functions(spark, d):
    values = F.array(*[F.col(c).cast("string") for c in ("l_partkey", "l_suppkey", "l_linenumber")])
    mask = F.array(F.lit(0), F.lit(1), F.lit(1))
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.element_at(values, 1).alias("second_"),
        F.array_join(values, ",").alias("joined"),
        F.array_join(drop_at(values, 2), ",").alias("without_second"),
        F.array_join(keep_where(values, mask), ",").alias("masked"),
        array_length(values).alias("length"),
    )


@query(
    """
    SELECT p_partkey, p_name FROM part
    WHERE NOT regexp_matches(p_name, 'red.+') AND NOT regexp_matches(p_brand, 'Brand#1')
    """
)
def regex_filter(spark, d):
    return table(spark, d, "part").where(
        ~F.col("p_name").rlike("red.+") & ~F.col("p_brand").rlike("Brand#1")
    ).select("p_partkey", "p_name")


@query(
    f"""
    SELECT o_orderkey, {round_sql("('0x' || substr(md5('42:' || o_orderkey), 1, 8))::UBIGINT / 4294967296.0::DOUBLE", 9)} AS u
    FROM orders
    """
)
def keyed_uniform(spark, d):
    return table(spark, d, "orders").select("o_orderkey", rounded(hash_uniform(42, F.col("o_orderkey")), 9).alias("u"))


