"""Matching of treated customers to controls."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradus.operators import matching as match
from gradus.queries.registry import query, round_sql, rounded, table


def study(spark, d):
    """Customers: one market segment is the treatment, spend the outcome."""
    spend = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum("o_totalprice").alias("outcome")
    )
    band = F.floor(F.col("c_acctbal") / 100)
    return table(spark, d, "customer").join(spend, "c_custkey", "left").select(
        "c_custkey",
        "outcome",
        F.when(F.col("c_mktsegment") == "BUILDING", "yes").otherwise("no").alias("treated"),
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("nation"),
        band.alias("band"),
    )


STUDY_SQL = """
    study AS (
        SELECT c_custkey, outcome, CASE WHEN c_mktsegment = 'BUILDING' THEN 'yes' ELSE 'no' END AS treated,
               CASE WHEN c_nationkey <> 3 THEN c_nationkey END AS nation, CAST(floor(c_acctbal / 100) AS BIGINT) AS band
        FROM customer LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS outcome FROM orders GROUP BY 1) ON o_custkey = c_custkey),
    ready AS (SELECT * FROM study WHERE nation IS NOT NULL AND outcome IS NOT NULL),
    coded AS (
        SELECT c_custkey, outcome, CAST(dense_rank() OVER (ORDER BY treated) - 1 AS INTEGER) AS treated,
               CAST(dense_rank() OVER (ORDER BY nation) AS INTEGER) AS nation, CAST(dense_rank() OVER (ORDER BY band) AS INTEGER) AS band
        FROM ready)"""


@query(f"WITH {STUDY_SQL} SELECT c_custkey, treated, nation, band FROM ready")
def match_nulls_omitted(spark, d):
    return match.match_nulls(study(spark, d)).drop("outcome")


@query(f"WITH {STUDY_SQL} SELECT c_custkey, {round_sql('coalesce(nation, (SELECT avg(nation) FROM study))')} AS nation FROM study")
def match_nulls_filled(spark, d):
    filled = match.match_nulls(study(spark, d).select("c_custkey", "nation"), omit=False, cols=["nation"])
    return filled.select("c_custkey", rounded("nation").alias("nation"))


def coded(spark, d):
    ready = match.match_nulls(study(spark, d))
    return match.factor_codes(ready, ["nation", "band"], "treated")


@query(f"WITH {STUDY_SQL} SELECT c_custkey, treated, nation, band FROM coded")
def factor_codes(spark, d):
    return coded(spark, d).drop("outcome")


NEAREST_SQL = f"""
    WITH {STUDY_SQL},
    s AS (SELECT var_samp(nation) AS vn, var_samp(band) AS vb, covar_samp(nation, band) AS c FROM coded),
    pairs AS (
        SELECT t.c_custkey, k.c_custkey AS matched_id,
               round(sqrt(greatest((vb * pow(t.nation - k.nation, 2) - 2 * c * (t.nation - k.nation) * (t.band - k.band)
                     + vn * pow(t.band - k.band, 2)) / (vn * vb - c * c), 0)), 8) AS distance
        FROM coded t JOIN coded k ON t.treated = 1 AND k.treated = 0, s),
    best AS (
        SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY distance, matched_id) AS rn FROM pairs)"""


@query(f"{NEAREST_SQL} SELECT c_custkey, matched_id, {round_sql('distance')} AS distance FROM best WHERE rn = 1")
def match_nearest(spark, d):
    found = match.match_nearest(coded(spark, d), "c_custkey", "treated", ["nation", "band"])
    return found.withColumn("distance", rounded("distance"))


CLOSE_SQL = """
    near AS (
        SELECT o_orderkey, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS urgent,
               o_custkey + (o_orderkey * 7919 % 1000) * 1e-10::DOUBLE AS x
        FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')"""


@query(
    f"""
    WITH {CLOSE_SQL}, pairs AS (
        SELECT t.o_orderkey, k.o_orderkey AS matched_id, (t.x - k.x) * (t.x - k.x) AS square
        FROM near t JOIN near k ON t.urgent = 1 AND k.urgent = 0 AND k.x BETWEEN t.x - 200 AND t.x + 200)
    SELECT o_orderkey, matched_id
    FROM pairs QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY square, matched_id) = 1
    """
)
def match_nearest_close(spark, d):
    """Distances that differ by a ten-billionth still decide."""
    x = F.col("o_custkey") + (F.col("o_orderkey") * 7919 % 1000) * F.lit(1e-10)
    early = table(spark, d, "orders").where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp"))
    rows = early.select("o_orderkey", (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("urgent"), x.alias("x"))
    return match.match_nearest(rows, "o_orderkey", "urgent", ["x"]).select("o_orderkey", "matched_id")


FRONTIER_SQL = f"""
    WITH {STUDY_SQL}, sums AS (SELECT sum(treated) AS t, sum(1 - treated) AS k FROM coded),
    cells AS (SELECT nation, sum(treated) AS t, sum(1 - treated) AS k FROM coded GROUP BY nation),
    numbered AS (
        SELECT c_custkey, nation, c.k * s.t - c.t * s.k - (row_number() OVER (PARTITION BY nation ORDER BY c_custkey) - 1) * s.t AS level
        FROM coded JOIN cells c USING (nation), sums s WHERE treated = 0),
    pruned AS (SELECT row_number() OVER (ORDER BY level DESC, nation, c_custkey) AS step, * FROM numbered WHERE level > 0),
    steps AS (SELECT 0 AS step UNION ALL SELECT step FROM pruned),
    gone AS (SELECT p.step, c.nation, count(*) FILTER (q.nation = c.nation) AS n
             FROM steps p CROSS JOIN cells c LEFT JOIN pruned q ON q.step <= p.step GROUP BY ALL),
    worth AS (
        SELECT g.step, sum(abs(c.t / s.t::DOUBLE - (c.k - g.n) / (s.k - g.step)::DOUBLE)) / 2 AS imbalance, any_value(s.k) - g.step AS controls_left
        FROM gone g JOIN cells c USING (nation), sums s GROUP BY g.step)"""


@query(
    f"""
    {FRONTIER_SQL}
    SELECT w.step::BIGINT AS step, c_custkey, controls_left::BIGINT AS controls_left, {round_sql("imbalance", 9)} AS imbalance
    FROM worth w LEFT JOIN pruned USING (step)
    """
)
def matching_frontier(spark, d):
    """Controls in the order in which they are pruned, with the imbalance after each."""
    found = match.matching_frontier(coded(spark, d), "c_custkey", "treated", ["nation"])
    return found.withColumn("imbalance", rounded("imbalance", 9))


CELLS_SQL = f"""
    WITH {STUDY_SQL}, numbered AS (
        SELECT *, row_number() OVER (PARTITION BY nation, treated ORDER BY c_custkey) AS rn FROM coded)"""


@query(
    f"""
    {CELLS_SQL}
    SELECT t.c_custkey, k.c_custkey AS matched_id FROM numbered t JOIN numbered k
      ON t.nation = k.nation AND t.rn = k.rn AND t.treated = 1 AND k.treated = 0
    """
)
def match_cells(spark, d):
    return match.match_cells(coded(spark, d), "c_custkey", "treated", ["nation"])


@query(
    f"""
    WITH {STUDY_SQL}
    SELECT {round_sql("sum(abs(t / (SELECT count(*) FROM coded WHERE treated = 1) - k / (SELECT count(*) FROM coded WHERE treated = 0))) / 2")} AS imbalance
    FROM (SELECT nation, count(*) FILTER (treated = 1)::DOUBLE AS t, count(*) FILTER (treated = 0)::DOUBLE AS k FROM coded GROUP BY nation)
    """
)
def cell_imbalance(spark, d):
    return match.cell_imbalance(coded(spark, d), "treated", ["nation"]).withColumn("imbalance", rounded("imbalance"))


@query(f"{NEAREST_SQL} SELECT c_custkey, matched_id FROM best WHERE rn = 1")
def matching(spark, d):
    return match.matching(study(spark, d), "c_custkey", "outcome", "treated")


@query(
    f"""
    {CELLS_SQL}
    SELECT t.c_custkey, k.c_custkey AS matched_id FROM numbered t JOIN numbered k
      ON t.nation = k.nation AND t.rn = k.rn AND t.treated = 1 AND k.treated = 0
    """
)
def matching_cells(spark, d):
    return match.matching(study(spark, d), "c_custkey", "outcome", "treated", ["nation"], distance="L1")
