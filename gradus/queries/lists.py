"""Cohort lists: identifiers, test scores, the roster and list differences."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from gradus.functions import normalize_id as cut_id
from gradus.operators import roster
from gradus.queries.assembly import APPLICATIONS_SQL, admitted_sql, applications
from gradus.queries.registry import query, round_sql, rounded, table

TERMS = ["199610", "199710"]
TERMS_SQL = "'199610', '199710'"


@query(
    """
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS person_uid FROM orders
    """
)
def normalize_id(spark, d):
    decimal = F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))
    mixed = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string")).otherwise(decimal)
    return table(spark, d, "orders").select("o_orderkey", cut_id(mixed).alias("person_uid"))


# ---------------------------------------------------------------- test scores

CODES = {"click": "S01", "view": "S02", "purchase": "A01", "signup": "A03", "error": "TIBT"}


def test_scores(spark, d):
    """Events as test results; the score is text."""
    code = F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair])
    return table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("person_uid"),
        code[F.col("event_type")].alias("test"),
        F.col("value").cast("string").alias("test_score"),
        F.col("ts").cast("date").alias("test_date"),
    )


SCORES_SQL = f"""
    tests AS (
        SELECT CAST(user_id AS VARCHAR) AS person_uid,
               CASE event_type {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CODES.items())} END AS test, value AS score,
               CAST(ts AS DATE) AS test_date
        FROM events),
    days AS (
        SELECT person_uid, test_date, sum(score) FILTER (test IN ('S01', 'S02')) AS sattot,
               sum(score) FILTER (test IN ('A01', 'A03')) AS acter
        FROM tests GROUP BY 1, 2),
    pivoted AS (
        SELECT t.person_uid, max(score) FILTER (test = 'S02') AS satm, max(score) FILTER (test = 'S01') AS satv,
               max(score) FILTER (test = 'S07') AS satw, max(score) FILTER (test = 'A01') AS acte,
               max(score) FILTER (test = 'A02') AS actm, max(score) FILTER (test = 'A05') AS act_comp,
               max(score) FILTER (test = 'A03') AS actr, max(score) FILTER (test = 'A07') AS actew,
               max(score) FILTER (test = 'TIBT') AS toefl,
               {round_sql("max(sattot)", 4)} AS sat_total, {round_sql("max(acter)", 4)} AS acter
        FROM tests t LEFT JOIN days ON t.person_uid = days.person_uid GROUP BY 1)"""


@query(f"WITH {SCORES_SQL} SELECT * FROM pivoted")
def test_score_pivot(spark, d):
    best = roster.test_score_pivot(test_scores(spark, d))
    return best.withColumns({c: rounded(c, 4) for c in roster.DAY_SUMS})


# --------------------------------------------------------------------- roster


def predictions(spark, d, upto: str):
    """Every customer with orders by a day, predicted by mean order price."""
    orders = table(spark, d, "orders").where(F.col("o_orderdate") <= F.lit(upto).cast("timestamp_ntz"))
    mean = orders.groupBy("o_custkey").agg(rounded(F.avg("o_totalprice") / 600000).alias("p"))
    return mean.select(
        F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("person_uid"),
        F.when(F.col("p") > 0.45, "1").otherwise("0").alias("class_label_predicted"),
        F.array(1 - F.col("p"), F.col("p")).alias("class_label_proba_predicted"),
    )


def predictions_sql(name: str, upto: str) -> str:
    return f"""
    {name} AS (
        SELECT CAST(o_custkey AS VARCHAR) AS person_uid, {round_sql("avg(o_totalprice) / 600000")} AS p,
               count(*) AS orders_by_then, {round_sql("max(o_totalprice)", 2)} AS dearest
        FROM orders WHERE o_orderdate <= TIMESTAMP '{upto}' GROUP BY 1)"""


def cohort_features(spark, d, upto: str):
    """The prediction table as of a day."""
    orders = table(spark, d, "orders").where(F.col("o_orderdate") <= F.lit(upto).cast("timestamp_ntz"))
    return orders.groupBy(F.col("o_custkey").cast("string").alias("person_uid")).agg(
        F.count("*").alias("hs_gpa"), rounded(F.max("o_totalprice"), 2).alias("hs_core_gpa")
    )


def persons(spark, d):
    return table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("person_uid"),
        F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("first_name"),
        F.substring("c_mktsegment", 1, 1).alias("middle_initial"),
        F.col("c_nationkey").alias("nation_of_citizenship_desc"),
        F.when(F.col("c_acctbal") > 5000, "F").otherwise("M").alias("gender"),
        F.when(F.col("c_nationkey") < 3, "Y").otherwise("N").alias("underrepresented_minority_ind"),
        F.col("c_nationkey").cast("string").alias("reporting_ethnicity"),
    )


def cohorts(spark, d):
    """Event users as cohort members, one row each."""
    return table(spark, d, "events").groupBy(F.col("user_id").cast("string").alias("person_uid")).agg(
        F.when(F.max("value") > 150, "SUMMERSTRT").otherwise("FALL").alias("cohort")
    )


def _roster(spark, d, upto: str):
    return roster.risk_roster(
        predictions(spark, d, upto), applications(spark, d), cohort_features(spark, d, upto), persons(spark, d),
        test_scores(spark, d), cohorts(spark, d), TERMS,
    )


def roster_sql(upto: str) -> str:
    return f"""
        SELECT college_desc AS college, p AS predicted_at_risk_probability,
               CASE WHEN s.best > 150 THEN 'Y' ELSE 'N' END AS summer_start_ind, a.id AS puid, c_name AS last_name,
               c_mktsegment AS first_name, substr(c_mktsegment, 1, 1) AS middle_initial, major_desc AS major,
               orders_by_then AS high_school_gpa, dearest AS high_school_core_gpa, residency,
               c_nationkey AS nation_of_citizenship, CASE WHEN c_acctbal > 5000 THEN 'F' ELSE 'M' END AS gender,
               CASE WHEN c_nationkey < 3 THEN 'Y' ELSE 'N' END AS underrepresented_minority_ind,
               CAST(c_nationkey AS VARCHAR) AS reporting_ethnicity, satm, satv, satw, sat_total, acte, actm, actr, actew,
               acter, act_comp, toefl
        FROM ({"SELECT * FROM (" + predictions_sql("x", upto).split("AS (", 1)[1].rsplit(")", 1)[0] + ")"}) t
        JOIN applications a ON t.person_uid = a.person_uid AND {admitted_sql(TERMS_SQL)}
        JOIN customer ON t.person_uid = CAST(c_custkey AS VARCHAR)
        LEFT JOIN pivoted ON t.person_uid = pivoted.person_uid
        LEFT JOIN (SELECT CAST(user_id AS VARCHAR) AS u, max(value) AS best FROM events GROUP BY 1) s ON s.u = t.person_uid
        WHERE p > 0.45"""


NOW, BEFORE = "2001-12-31", "1998-06-30"


@query(f"WITH {APPLICATIONS_SQL}, {SCORES_SQL} {roster_sql(NOW)}")
def risk_roster(spark, d):
    listed = _roster(spark, d, NOW)
    return listed.withColumns({c: rounded(c, 4) for c in roster.DAY_SUMS})


# ---------------------------------------------------------------- differences

LISTS_SQL = f"""
    {APPLICATIONS_SQL}, {predictions_sql("now_p", NOW)}, {predictions_sql("before_p", BEFORE)},
    now_list AS (SELECT 'P' || person_uid AS puid, p FROM now_p WHERE p > 0.45),
    before_list AS (SELECT 'P' || person_uid AS puid, p FROM before_p WHERE p > 0.45)"""


def short_list(spark, d, upto: str):
    """Listed persons by their public id."""
    p = predictions(spark, d, upto)
    return p.where(F.col("class_label_predicted") == "1").select(
        F.concat(F.lit("P"), cut_id(F.col("person_uid"))).alias("puid"),
        F.element_at("class_label_proba_predicted", 2).alias("p"),
    )


def lookup(spark, d):
    key = F.col("c_custkey").cast("string")
    return table(spark, d, "customer").select(F.concat(F.lit("P"), key).alias("puid"), key.alias("person_uid"))


@query(f"WITH {LISTS_SQL} SELECT * FROM now_list WHERE puid NOT IN (SELECT puid FROM before_list)")
def list_added(spark, d):
    return roster.list_added(short_list(spark, d, NOW), short_list(spark, d, BEFORE))


@query(f"WITH {LISTS_SQL} SELECT * FROM before_list WHERE puid NOT IN (SELECT puid FROM now_list)")
def list_removed(spark, d):
    return roster.list_removed(short_list(spark, d, NOW), short_list(spark, d, BEFORE))


def admitted_by(spark, d, term: str):
    """Persons with an application in a term: one cohort table."""
    return applications(spark, d).where(
        (F.col("academic_period") == term) & F.col("latest_decision").isin("AA", "AN")
    ).groupBy("person_uid").agg(F.count("*").alias("applications"), F.max("major_desc").alias("last_major"))


def admitted_by_sql(name: str, term: str) -> str:
    return f"""
    {name} AS (
        SELECT person_uid, count(*) AS applications, max(major_desc) AS last_major FROM applications
        WHERE academic_period = '{term}' AND latest_decision IN ('AA', 'AN') GROUP BY 1)"""


COHORTS_SQL = f"{LISTS_SQL}, {admitted_by_sql('old_cohort', '199610')}, {admitted_by_sql('new_cohort', '199710')}"


@query(
    f"""
    WITH {COHORTS_SQL}
    SELECT a.* FROM applications a JOIN now_list ON a.id = puid
    WHERE a.person_uid NOT IN (SELECT person_uid FROM old_cohort) AND academic_period IN ({TERMS_SQL})
    """
)
def added_by_admission(spark, d):
    return roster.added_by_admission(
        short_list(spark, d, NOW), lookup(spark, d), admitted_by(spark, d, "199610"), applications(spark, d), TERMS
    )


@query(
    f"""
    WITH {COHORTS_SQL}
    SELECT a.* FROM applications a JOIN before_list ON a.id = puid
    WHERE a.person_uid NOT IN (SELECT person_uid FROM new_cohort) AND academic_period IN ({TERMS_SQL})
    """
)
def removed_by_cancellation(spark, d):
    return roster.removed_by_cancellation(
        short_list(spark, d, BEFORE), lookup(spark, d), admitted_by(spark, d, "199710"), applications(spark, d), TERMS
    )


def _changed_sql(listed: str, other: str) -> str:
    return f"""
    WITH {COHORTS_SQL}, alone AS (SELECT puid, substr(puid, 2) AS person_uid FROM {listed} WHERE puid NOT IN (SELECT puid FROM {other})),
    kept AS (SELECT * FROM alone WHERE person_uid IN (SELECT person_uid FROM old_cohort) AND person_uid IN (SELECT person_uid FROM new_cohort))
    SELECT DATE '2016-06-15' AS dt_created, o.*, puid FROM old_cohort o JOIN kept USING (person_uid)
    UNION
    SELECT DATE '2016-08-23', n.*, puid FROM new_cohort n JOIN kept USING (person_uid)"""


@query(_changed_sql("now_list", "before_list"))
def changed_records_added(spark, d):
    return roster.changed_records(
        short_list(spark, d, NOW), short_list(spark, d, BEFORE), lookup(spark, d), admitted_by(spark, d, "199610"),
        admitted_by(spark, d, "199710"), date(2016, 6, 15), date(2016, 8, 23),
    )


@query(_changed_sql("before_list", "now_list"))
def changed_records_removed(spark, d):
    return roster.changed_records(
        short_list(spark, d, BEFORE), short_list(spark, d, NOW), lookup(spark, d), admitted_by(spark, d, "199610"),
        admitted_by(spark, d, "199710"), date(2016, 6, 15), date(2016, 8, 23),
    )
