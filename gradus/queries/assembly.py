"""Feature-table assembly, calendars, build logs and the builder specifications."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from gradus.operators.assemble import (
    FeatureRules,
    admitted_cohort,
    assemble_features as assemble,
    assemble_stored as join_stored,
    grade_subset as large_courses,
    join_year_level as year_join,
    label_subset as labelled_rows,
    term_split as split_by_term,
)
from gradus.operators.intervals import interval_counts as count_in_intervals
from gradus.operators.intervals import interval_join
from gradus.plans import specs
from gradus.plans.build import build_model as build
from gradus.plans.build import due_tables
from gradus.queries.clauses import BUILD_LOG_SQL, build_log
from gradus.queries.models import TESTED_SQL
from gradus.queries.preparation import UNIFORM_SQL
from gradus.queries.registry import query, rounded, table
from gradus.sources import current_term as term_today
from gradus.sources import stale_tables as find_stale
from gradus.sources import term_changed_tables as find_changed
from gradus.sources import term_of
from gradus.sources.tables import buckets_of, store_clustered

# --------------------------------------------------------------- calendars


def calendar(spark, d):
    """One term per year in which orders were placed."""
    years = table(spark, d, "orders").select(F.year("o_orderdate").alias("y")).distinct()
    return years.select(
        F.col("y").cast("string").alias("academic_period"),
        F.make_date("y", F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date("y", F.lit(12), F.lit(31)).alias("end_date"),
    )


CALENDAR_SQL = """
    calendar AS (
        SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS academic_period,
               make_date(year(o_orderdate), 1, 1) AS start_date, make_date(year(o_orderdate), 12, 31) AS end_date
        FROM orders)"""


@query(
    f"""
    WITH {CALENDAR_SQL}
    SELECT l_orderkey, l_linenumber, academic_period
    FROM lineitem LEFT JOIN calendar ON CAST(l_shipdate AS DATE) BETWEEN start_date AND end_date
    """
)
def interval_lookup(spark, d):
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return term_of(items, F.col("l_shipdate"), calendar(spark, d)).drop("l_shipdate")


# Features of customers in tables of their own: name, aggregate in SQL, source.
STORED = (
    ("spend", "sum(o_totalprice)", "orders"),
    ("orders_placed", "count(*)", "orders"),
    ("last_order", "max(o_orderdate)", "orders"),
    ("urgent", "count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END)", "orders"),
    ("finished", "count(CASE WHEN o_orderstatus = 'F' THEN 1 END)", "orders"),
    ("largest", "max(o_totalprice)", "orders"),
)


def stored_customers(spark, d):
    """Customers and six feature tables, clustered on the customer under names of this run alone."""
    orders = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    base = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    buckets, run = max(4, buckets_of(base)), uuid.uuid4().hex[:12]
    features = [
        store_clustered(orders.groupBy("c_custkey").agg(F.expr(sql).alias(name)), f"gradus_{name}_{run}", "c_custkey", buckets)
        for name, sql, _ in STORED
    ]
    return store_clustered(base, f"gradus_customer_{run}", "c_custkey", buckets), features


@query(
    "SELECT c_custkey, c_mktsegment, "
    + ", ".join(name for name, _, _ in STORED)
    + " FROM customer LEFT JOIN (SELECT o_custkey, "
    + ", ".join(f"{sql} AS {name}" for name, sql, _ in STORED)
    + " FROM orders GROUP BY 1) ON o_custkey = c_custkey"
)
def assemble_stored(spark, d):
    """Tables clustered on their key, joined without moving again."""
    return join_stored(*stored_customers(spark, d), "c_custkey")


# Windows of minutes to days: errors open one of their user, as long as their value says.
WINDOWS_SQL = """
    windows AS (
        SELECT event_id AS error_id, user_id, ts AS opened,
               ts + to_minutes(CAST(if(value > 15, 3000, floor(value * 10)) AS BIGINT)) AS closed
        FROM events WHERE event_type = 'error')"""


def _windows(spark, d):
    minutes = F.when(F.col("value") > 15, 3000).otherwise(F.floor(F.col("value") * 10)).cast("int")
    closed = F.col("ts") + F.make_dt_interval(mins=minutes)
    errors = table(spark, d, "events").where("event_type = 'error'")
    return errors.select(F.col("event_id").alias("error_id"), "user_id", F.col("ts").alias("opened"), closed.alias("closed"))


@query(
    f"""
    WITH {WINDOWS_SQL}
    SELECT e.event_id, e.user_id, e.ts, error_id, opened, closed
    FROM events e LEFT JOIN windows w ON e.user_id = w.user_id AND e.ts BETWEEN opened AND closed
    """
)
def interval_lookup_times(spark, d):
    """Events beside the error windows of their user that they fall in, or alone."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts")
    return interval_join(events, _windows(spark, d), "ts", "opened", "closed", on=["user_id"], how="left")


@query(
    f"""
    WITH {WINDOWS_SQL}
    SELECT error_id, count(*) AS n, count(DISTINCT e.user_id) AS users
    FROM events e JOIN windows w ON e.ts >= opened AND e.ts < closed GROUP BY error_id
    """
)
def interval_counts(spark, d):
    """Events of all users during each error window, its end left out."""
    events = table(spark, d, "events").select("event_id", F.col("user_id").alias("who"), "ts")
    return count_in_intervals(events, _windows(spark, d), "ts", "opened", "closed", "error_id", "who", closed=False)


@query(
    f"""
    WITH {CALENDAR_SQL}
    SELECT academic_period FROM calendar WHERE DATE '1998-03-05' >= start_date AND DATE '1998-03-05' <= end_date
    """
)
def current_term(spark, d):
    return term_today(calendar(spark, d), date(1998, 3, 5))


@query(
    f"""
    WITH {BUILD_LOG_SQL}
    SELECT table_name, CAST(max(ts) AS DATE) AS last_build,
           date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-10') AS age_days
    FROM build_log WHERE action = 'CREATE' AND subtype = 'TABLE' GROUP BY table_name
    HAVING date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-10') > 10
    """
)
def stale_tables(spark, d):
    found = find_stale(build_log(spark, d), date(2024, 2, 10), 10)
    return found.withColumn("age_days", F.col("age_days").cast("bigint"))


def per_customer_builds(spark, d):
    """Every order read as the build of its customer's table."""
    return table(spark, d, "orders").select(
        F.concat(F.lit("person."), F.col("o_custkey").cast("string")).alias("table_name"),
        F.when(F.col("o_orderstatus") == "P", "DROP").otherwise("CREATE").alias("action"),
        F.lit("TABLE").alias("subtype"),
        F.col("o_orderdate").alias("ts"),
    )


@query(
    f"""
    WITH {CALENDAR_SQL}, builds AS (
        SELECT 'person.' || o_custkey AS table_name, CAST(max(o_orderdate) AS DATE) AS last_build
        FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
    SELECT table_name, last_build, c.academic_period AS last_term, '2001' AS current_term
    FROM builds JOIN calendar c ON last_build BETWEEN start_date AND end_date
    WHERE c.academic_period <> '2001'
    """
)
def term_changed_tables(spark, d):
    return find_changed(per_customer_builds(spark, d), date(2001, 7, 1), calendar(spark, d))


# ---------------------------------------------------------------- assembly


def enrolments(spark, d):
    """Order lines as enrolments of a person in a course and term."""
    orders = table(spark, d, "orders")
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    parts = table(spark, d, "part").select("p_partkey", "p_type")
    joined = items.join(orders, items["l_orderkey"] == orders["o_orderkey"]).join(
        parts, items["l_partkey"] == parts["p_partkey"]
    )
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("pk1"),
        F.col("o_custkey").cast("string").alias("person_uid"),
        F.year("o_orderdate").cast("string").alias("academic_period"),
        F.col("p_type").alias("course_identification"),
        F.col("l_quantity").alias("course_gpa"),
    )


ENROLMENTS_SQL = """
    enrolments AS (
        SELECT l_orderkey || '-' || l_linenumber AS pk1, CAST(o_custkey AS VARCHAR) AS person_uid,
               CAST(year(o_orderdate) AS VARCHAR) AS academic_period, p_type AS course_identification,
               l_quantity AS course_gpa
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def person_features(spark, d):
    """Event counts per person; most persons have none."""
    return table(spark, d, "events").groupBy(F.col("user_id").cast("string").alias("person_uid")).agg(
        F.count("*").alias("event_count"), rounded(F.sum("value"), 2).alias("event_value"), F.max("event_id").alias("id")
    )


def person_term_features(spark, d):
    return table(spark, d, "orders").groupBy(
        F.col("o_custkey").cast("string").alias("person_uid"),
        F.year("o_orderdate").cast("string").alias("academic_period"),
    ).agg(F.count("*").alias("orders_in_term"), F.max("o_totalprice").alias("hs_nation_best"))


def course_features(spark, d):
    return table(spark, d, "part").groupBy(F.col("p_type").alias("course_identification")).agg(
        F.count("*").alias("course_size"), F.max("p_retailprice").alias("dearest")
    )


def aid_features(spark, d):
    """Per person and year, with years written in full."""
    return table(spark, d, "orders").groupBy(
        F.col("o_custkey").cast("string").alias("person_uid"),
        (F.year("o_orderdate") + 1).cast("string").alias("aid_year"),
    ).agg(F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("aid_count"))


FEATURES_SQL = """
    person_f AS (
        SELECT CAST(user_id AS VARCHAR) AS person_uid, count(*) AS event_count,
               round(sum(value), 2) + 0.0 AS event_value
        FROM events GROUP BY 1),
    term_f AS (
        SELECT CAST(o_custkey AS VARCHAR) AS person_uid, CAST(year(o_orderdate) AS VARCHAR) AS academic_period,
               count(*) AS orders_in_term
        FROM orders GROUP BY 1, 2),
    course_f AS (
        SELECT p_type AS course_identification, count(*) AS course_size, max(p_retailprice) AS dearest
        FROM part GROUP BY 1),
    aid_f AS (
        SELECT CAST(o_custkey AS VARCHAR) AS person_uid, CAST(year(o_orderdate) + 1 AS VARCHAR) AS aid_year,
               count(*) FILTER (o_orderstatus = 'F') AS aid_count
        FROM orders GROUP BY 1, 2)"""


@query(
    f"""
    WITH {ENROLMENTS_SQL}, {FEATURES_SQL}
    SELECT pk1, t1.person_uid, academic_period, course_identification, course_gpa, aid_count
    FROM enrolments t1 LEFT JOIN aid_f t2
      ON t1.person_uid = t2.person_uid AND substr(academic_period, 3, 2) = substr(aid_year, 3, 2)
    """
)
def join_year_level(spark, d):
    return year_join(enrolments(spark, d), aid_features(spark, d))


ASSEMBLED_SQL = f"""
    WITH {ENROLMENTS_SQL}, {FEATURES_SQL}
    SELECT pk1, e.person_uid, e.academic_period, e.course_identification, course_gpa,
           event_count, event_value, orders_in_term, course_size, dearest, aid_count
    FROM enrolments e
    LEFT JOIN person_f USING (person_uid)
    LEFT JOIN term_f ON e.person_uid = term_f.person_uid AND e.academic_period = term_f.academic_period
    LEFT JOIN course_f ON e.course_identification = course_f.course_identification
    LEFT JOIN aid_f ON e.person_uid = aid_f.person_uid AND substr(e.academic_period, 3, 2) = substr(aid_year, 3, 2)
    """


def _tables(spark, d):
    return {
        "base": enrolments(spark, d),
        "persons": person_features(spark, d),
        "terms": person_term_features(spark, d),
        "courses": course_features(spark, d),
        "aid": aid_features(spark, d),
    }


@query(ASSEMBLED_SQL)
def assemble_features(spark, d):
    tables = _tables(spark, d)
    base = tables.pop("base")
    rules = FeatureRules(
        exclude=(*specs.IDENTITY_COLUMNS, *specs.GRADE_KEY_COLUMNS),
        exclude_regex=(specs.NATION,),
        year_level=("aid",),
    )
    return assemble(base, tables, rules)


@query(ASSEMBLED_SQL)
def template_input(spark, d):
    spec = specs.template_spec(
        "base", {"sis": ["persons", "terms"], "lms": ["courses"], "card": ["aid"]}, year_level=("aid",)
    )
    return specs.build_input(spec, _tables(spark, d), ["sis", "lms", "unknown", "card"])


def _fan_out(spark, d):
    """One row per person and order status, so a person's key repeats."""
    return table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("person_uid"), F.col("o_orderstatus").alias("status_feature")
    ).distinct()


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS person_uid, c_acctbal, status_feature
    FROM customer LEFT JOIN (SELECT DISTINCT o_custkey, o_orderstatus AS status_feature FROM orders) ON c_custkey = o_custkey
    """
)
def assemble_fan_out(spark, d):
    base = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("person_uid"), "c_acctbal")
    return assemble(base, {"status": _fan_out(spark, d)}, FeatureRules(exclude=("person_uid",)))


# ------------------------------------------------------------- applications


def applications(spark, d):
    """Orders read as applications of their customers."""
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    status = F.col("o_orderstatus")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        F.col("o_custkey").cast("string").alias("person_uid"),
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("id"),
        F.concat(F.year("o_orderdate").cast("string"), F.lit("10")).alias("academic_period"),
        F.when(status == "F", "AA").when(status == "O", "AN").otherwise("RJ").alias("latest_decision"),
        F.when(F.col("c_nationkey") < 20, "PWL").otherwise("NWL").alias("campus"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "T").when(F.col("c_mktsegment") == "BUILDING", "SB").otherwise("B").alias("admissions_population"),
        F.lit("U").alias("student_level"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(2).alias("curriculum_priority_number"),
        F.col("c_mktsegment").alias("college_desc"),
        F.col("o_orderpriority").alias("major_desc"),
        F.when(F.col("c_nationkey") < 5, "R").otherwise("N").alias("residency"),
    )


APPLICATIONS_SQL = """
    applications AS (
        SELECT CAST(o_custkey AS VARCHAR) AS person_uid, 'P' || o_custkey AS id,
               CAST(year(o_orderdate) AS VARCHAR) || '10' AS academic_period,
               CASE o_orderstatus WHEN 'F' THEN 'AA' WHEN 'O' THEN 'AN' ELSE 'RJ' END AS latest_decision,
               CASE WHEN c_nationkey < 20 THEN 'PWL' ELSE 'NWL' END AS campus,
               CASE c_mktsegment WHEN 'MACHINERY' THEN 'T' WHEN 'BUILDING' THEN 'SB' ELSE 'B' END AS admissions_population,
               'U' AS student_level,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 2 END AS curriculum_priority_number,
               c_mktsegment AS college_desc, o_orderpriority AS major_desc,
               CASE WHEN c_nationkey < 5 THEN 'R' ELSE 'N' END AS residency
        FROM orders JOIN customer ON o_custkey = c_custkey)"""


def admitted_sql(terms: str) -> str:
    return f"""
        latest_decision IN ('AA', 'AN') AND campus = 'PWL' AND admissions_population IN ('B', 'SB')
        AND student_level IN ('U', 'UG') AND curriculum_priority_number = 1 AND academic_period IN ({terms})"""


@query(
    f"""
    WITH {APPLICATIONS_SQL}
    SELECT DISTINCT person_uid FROM applications WHERE {admitted_sql("'199610', '199710'")}
    """,
    name="admitted_cohort",
)
def admitted(spark, d):
    return admitted_cohort(applications(spark, d), ["199610", "199710"])


# ------------------------------------------------------------------ subsets


@query(
    """
    SELECT o_orderkey, CASE WHEN CAST(term AS INTEGER) < 1999 THEN 'train' ELSE 'score' END AS part
    FROM (SELECT o_orderkey, CAST(year(nullif(o_orderdate, TIMESTAMP '1995-01-01')) AS VARCHAR) AS term FROM orders)
    WHERE CAST(term AS INTEGER) < 1999 OR term IN ('1999', '2000')
    """
)
def term_split(spark, d):
    known = F.nullif(F.col("o_orderdate"), F.lit("1995-01-01").cast("timestamp_ntz"))
    terms = table(spark, d, "orders").select(
        "o_orderkey", F.year(known).cast("string").alias("academic_period")
    )
    train, score = split_by_term(terms, 1999, ["1999", "2000"])
    return train.select("o_orderkey", F.lit("train").alias("part")).unionByName(
        score.select("o_orderkey", F.lit("score").alias("part"))
    )


@query(
    """
    SELECT p_type AS course_identification, CAST(year(l_shipdate) AS VARCHAR) AS academic_period, count(*) AS course_size
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY 1, 2 HAVING count(*) >= 1300 AND CAST(year(l_shipdate) AS VARCHAR) IN ('1996', '1997', '1998')
    """
)
def grade_subset(spark, d):
    items = table(spark, d, "lineitem").select("l_partkey", "l_shipdate")
    parts = table(spark, d, "part").select("p_partkey", "p_type")
    sizes = items.join(parts, items["l_partkey"] == parts["p_partkey"]).groupBy(
        F.col("p_type").alias("course_identification"), F.year("l_shipdate").cast("string").alias("academic_period")
    ).agg(F.count("*").alias("course_size"))
    return large_courses(sizes, ["1996", "1997", "1998"], min_size=1300)


@query(
    """
    SELECT doc_id, n_chars, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL
    """
)
def label_subset(spark, d):
    joined = table(spark, d, "documents").select("doc_id", "n_chars").join(
        table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left"
    )
    return labelled_rows(joined, "quality")


# ----------------------------------------------------------------- builders


def spec_tables(spark, d, spec):
    """Tables under a spec's names: every second one from events, the rest from customers.

    Each holds one feature beside columns the rules must leave out. Feature
    names carry the position of the table.
    """
    customer, events = table(spark, d, "customer"), table(spark, d, "events")
    out = {}
    for i, name in enumerate(spec.feature_tables()):
        if name == specs.PROFILE:
            out[name] = customer.select(
                F.col("c_custkey").cast("string").alias("person_uid"),
                F.when(F.col("c_nationkey") < 8, "201510").when(F.col("c_nationkey") < 16, "201610").otherwise("201710").alias("profile_academic_period"),
                F.col("c_acctbal").alias("profile_gpa"),
            )
        elif i % 2:
            out[name] = customer.select(
                F.col("c_custkey").cast("string").alias("person_uid"),
                (F.col("c_acctbal") + i).alias(f"feature_{i}"),
                F.lit(1).alias("hs_zip"),
                F.col("c_nationkey").alias(f"hs_state_ny{i}"),
                F.col("c_nationkey").alias(f"hs_state_in{i}"),
                F.col("c_nationkey").alias(f"app_race{i}"),
            )
        else:
            out[name] = events.groupBy(F.col("user_id").cast("string").alias("person_uid")).agg(
                (F.count("*") + i).alias(f"feature_{i}"),
                F.max("value").alias(f"hs_nation_{i}"),
                F.max("user_id").alias("puid"),
            )
    return out


def _spec_sql(spec, base_sql: str, race: bool) -> str:
    """Expected columns of ``spec_tables`` written as one select."""
    columns, profile = [], ""
    for i, name in enumerate(spec.feature_tables()):
        if name == specs.PROFILE:
            profile = (
                ", CASE WHEN c_nationkey < 8 THEN '201510' WHEN c_nationkey < 16 THEN '201610' "
                "ELSE '201710' END AS profile_academic_period"
            )
        elif i % 2:
            columns.append(f"c_acctbal + {i} AS feature_{i}")
            columns.append(f"c_nationkey AS hs_state_in{i}")
            if race:
                columns.append(f"c_nationkey AS app_race{i}")
        else:
            columns.append(f"event_count + {i} AS feature_{i}")
    return f"""
        SELECT b.*, {", ".join(columns)}{profile}
        FROM ({base_sql}) b JOIN customer ON b.person_uid = CAST(c_custkey AS VARCHAR)
        LEFT JOIN (SELECT user_id, count(*) AS event_count FROM events GROUP BY 1) ON user_id = c_custkey"""


RISK_BASE_SQL = """
    SELECT CAST(c_custkey AS VARCHAR) AS person_uid, CAST(c_acctbal < 1000 AS INTEGER) AS at_risk_ind_cume FROM customer"""


def _risk_input(spark, d, spec):
    base = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("person_uid"),
        (F.col("c_acctbal") < 1000).cast("int").alias("at_risk_ind_cume"),
    )
    built = specs.build_input(spec, {spec.base: base, **spec_tables(spark, d, spec)})
    train, score = specs.train_and_score(spec, built)
    return train.withColumn("part", F.lit("train")).unionByName(score.withColumn("part", F.lit("score")))


def _risk_sql(spec, race: bool) -> str:
    return f"""
    SELECT *, CASE WHEN CAST(profile_academic_period AS INTEGER) < {spec.cutoff} THEN 'train' ELSE 'score' END AS part
    FROM ({_spec_sql(spec, RISK_BASE_SQL, race)})
    WHERE CAST(profile_academic_period AS INTEGER) < {spec.cutoff} OR profile_academic_period = '{spec.score_terms[0]}'"""


@query(_risk_sql(specs.AT_RISK_2016, race=True))
def at_risk_input_2016(spark, d):
    return _risk_input(spark, d, specs.AT_RISK_2016)


@query(_risk_sql(specs.AT_RISK_2017, race=False))
def at_risk_input_2017(spark, d):
    return _risk_input(spark, d, specs.AT_RISK_2017)


def _prediction_sql(spec, race: bool) -> str:
    terms = ", ".join(f"'{t}'" for t in spec.admitted_terms)
    shifted = APPLICATIONS_SQL.replace(
        "CAST(year(o_orderdate) AS VARCHAR) || '10'", "CAST(year(o_orderdate) + 20 AS VARCHAR) || '10'"
    )
    base = f"SELECT DISTINCT person_uid FROM applications WHERE {admitted_sql(terms)}"
    return f"WITH {shifted} {_spec_sql(spec, base, race)}"


def _prediction_input(spark, d, spec):
    """Applications moved twenty years on, so that they meet the spec's terms."""
    term = F.col("academic_period")
    later = F.concat((F.substring(term, 1, 4).cast("int") + 20).cast("string"), F.substring(term, 5, 2))
    moved = applications(spark, d).withColumn("academic_period", later)
    return specs.build_input(spec, {spec.base: moved, **spec_tables(spark, d, spec)})


@query(_prediction_sql(specs.PREDICTION_2016, race=True))
def prediction_input_2016(spark, d):
    return _prediction_input(spark, d, specs.PREDICTION_2016)


@query(_prediction_sql(specs.PREDICTION_2017, race=False))
def prediction_input_2017(spark, d):
    return _prediction_input(spark, d, specs.PREDICTION_2017)


def _grade_tables(spark, d):
    """Card and network tables of the grade spec, on each kind of key."""
    spec = specs.grade_spec()
    network = table(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("person_uid")).agg(
        F.count("*").alias("sessions"), F.max("o_totalprice").alias("perc_attendance_lec")
    )
    buddies, swipes, study = spec.sources["card"]
    return {
        spec.base: enrolments(spark, d),
        buddies: person_features(spark, d),
        swipes: person_term_features(spark, d).withColumnRenamed("hs_nation_best", "ap_bio"),
        study: course_features(spark, d).withColumnRenamed("dearest", "possible_points"),
        spec.sources["netlog"][0]: network,
    }


@query(
    f"""
    WITH {ENROLMENTS_SQL}, {FEATURES_SQL}
    SELECT pk1, e.person_uid, e.academic_period, e.course_identification, course_gpa,
           sessions, event_count, event_value, orders_in_term, course_size
    FROM enrolments e
    LEFT JOIN (SELECT CAST(o_custkey AS VARCHAR) AS person_uid, count(*) AS sessions FROM orders GROUP BY 1) USING (person_uid)
    LEFT JOIN person_f USING (person_uid)
    LEFT JOIN term_f ON e.person_uid = term_f.person_uid AND e.academic_period = term_f.academic_period
    LEFT JOIN course_f ON e.course_identification = course_f.course_identification
    """
)
def grade_input(spark, d):
    return specs.build_input(specs.grade_spec(), _grade_tables(spark, d), ["netlog", "card"])


# Feature tables of the grade input over all four sources. Fixed values.
GRADE_FEATURE_TABLES = (
    "features_course_schedule.course_size",
    "features_demographics.application_tests",
    "features_demographics.high_school",
    "features_demographics.high_school_inst_gpa",
    "features_demographics.high_school_core_gpa",
    "features_demographics.acs_2015_hs_zip",
    "features_demographics.same_high_school",
    "features_grade.course_cdfw_rates",
    "features_grade.person_semester_cdfw_rates",
    "features_grade.in_subject_gpa",
    "features_grade.hs_vs_own_gpa_diff",
    "features_grade.repeat_course_ind",
    "features_grade.prior_own_gpa",
    "features_course_schedule.instructor_difficulty_experience",
    "features_academic_study.num_sems_enrolled",
    "features_academic_study.num_class_min_per_week",
    "features_academic_study.schedule_types",
    "features_academic_study.offering_course",
    "features_grade.important_priors",
    "features_learning_management.lms_db_msg_posted_asof_4_wk_past",
    "features_learning_management.lms_gradebook_cnt_1st_view_asof_4_wk_past",
    "ip.gradebook_features",
    "features_card_service.board_plan_rectrac_buddies",
    "features_card_service.weekly_rectrac_swipes",
    "features_card_service.si_sessions",
    "features_network.attendance_by_person_course",
)


@query(
    f"""
    WITH {ENROLMENTS_SQL},
    spent AS (SELECT CAST(o_custkey AS VARCHAR) AS person_uid, count(*) AS n FROM orders GROUP BY 1)
    SELECT e.*, {", ".join(f"n + {i} AS value_{i}" for i in range(len(GRADE_FEATURE_TABLES)))}
    FROM enrolments e JOIN spent USING (person_uid)
    """
)
def grade_input_all_groups(spark, d):
    """Each table of the list brings one column; a table that is not joined leaves its column out."""
    spent = table(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("person_uid")).agg(F.count("*").alias("n"))
    spec = specs.grade_spec()
    tables = {
        name: spent.select("person_uid", (F.col("n") + i).alias(f"value_{i}"), F.lit(1).alias("puid"))
        for i, name in enumerate(GRADE_FEATURE_TABLES)
    }
    return specs.build_input(spec, {spec.base: enrolments(spark, d), **tables}, ["sis", "lms", "card", "netlog"])


def _build_log_of_spec(spark, d):
    """Builds of the at-risk tables, dated by the events of one type each."""
    spec = specs.AT_RISK_2017
    kinds = ["click", "error", "purchase", "signup", "view"]
    pairs = [(kinds[i % 5], name) for i, name in enumerate((*spec.daily, *spec.census))]
    names = F.create_map(*[F.lit(x) for kind in kinds for x in (kind, ",".join(n for k, n in pairs if k == kind))])
    events = table(spark, d, "events").select("ts", "value", F.explode(F.split(names[F.col("event_type")], ",")).alias("table_name"))
    action = F.when(F.col("value") >= 250, "CREATE").otherwise("ANALYZE")
    return events.select("table_name", action.alias("action"), F.lit("TABLE").alias("subtype"), "ts")


@query(
    """
    SELECT table_name FROM (
        SELECT table_name, max(ts) AS last FROM (
            SELECT unnest(CASE event_type
                WHEN 'click' THEN ['features_dependent_variables.at_risk_dep_var', 'features_demographics.high_school', 'features_demographics.acs_2015_hs_zip']
                WHEN 'error' THEN ['features_demographics.application_demos', 'features_demographics.high_school_inst_gpa', 'features_demographics.decision_count']
                WHEN 'purchase' THEN ['features_demographics.application_tests', 'features_demographics.high_school_core_gpa', 'features_demographics.feats_from_person_detail_table']
                WHEN 'signup' THEN ['features_demographics.admission_attributes', 'features_demographics.high_school_driving_time', 'features_demographics.admitted_college']
                WHEN 'view' THEN ['features_demographics.admission_decision', 'features_demographics.high_school_to_regional_rep_dist', 'features_demographics.feats_from_profile_table']
                END) AS table_name, ts FROM events WHERE value >= 250)
        GROUP BY table_name)
    WHERE table_name <> 'features_demographics.feats_from_profile_table' AND date_diff('day', CAST(last AS DATE), DATE '2024-02-15') > 17
    """
)
def tables_due(spark, d):
    """Daily tables by age; the census table's term has not turned."""
    event_days = table(spark, d, "events").agg(
        F.date_trunc("year", F.min("ts")).cast("date").alias("start_date"),
        F.last_day(F.add_months(F.date_trunc("year", F.min("ts")).cast("date"), 11)).alias("end_date"),
    ).withColumn("academic_period", F.year("start_date").cast("string"))
    return due_tables(specs.AT_RISK_2017, _build_log_of_spec(spark, d), event_days, date(2024, 2, 15), 17)


@query(ASSEMBLED_SQL)
def build_model_assemble_only(spark, d):
    spec = specs.template_spec(
        "base", {"sis": ["persons", "terms"], "lms": ["courses"], "card": ["aid"]}, year_level=("aid",)
    )
    result = build(
        spec, _tables(spark, d), per_customer_builds(spark, d), calendar(spark, d), date(2001, 7, 1),
        "pk1", "course_gpa", models=["", "nothing"],
    )
    return result.rows




# A label that the grade explains in part.
PASSED = "CAST(course_gpa + CAST(split_part(pk1, '-', 1) AS BIGINT) * 7919 % 40 > 45 AS INTEGER)"


@query(
    f"""
    WITH built AS (SELECT pk1, {PASSED} AS passed FROM ({ASSEMBLED_SQL})),
    {TESTED_SQL.format(uniform=UNIFORM_SQL.format(seed=42, key="pk1"), source="built", key="pk1")},
    single AS (SELECT * FROM drawn QUALIFY count(*) OVER (PARTITION BY pk1) = 1)
    SELECT 'LR' AS model, CAST(passed AS VARCHAR) AS class, count(*) AS tested FROM single WHERE u > 0.8 GROUP BY passed
    UNION ALL SELECT 'XGBoost', CAST(passed AS VARCHAR), count(*) FROM tested GROUP BY passed
    UNION ALL SELECT 'nothing', 'Unrecognized model name: nothing', 0
    """
)
def build_model_runs(spark, d):
    """From feature tables to a logistic and a boosted model in one call: the rows that each is tested on."""
    spec = specs.template_spec(
        "base", {"sis": ["persons", "terms"], "lms": ["courses"], "card": ["aid"]}, year_level=("aid",)
    )
    tables = _tables(spark, d)
    tables["base"] = tables["base"].withColumn("passed", F.expr(PASSED))
    result = build(
        spec, tables, per_customer_builds(spark, d), calendar(spark, d), date(2001, 7, 1), "pk1", "passed",
        models=["", "LR", "XGBoost", "nothing"], logistic={"folds": 2},
        boosted={"grid": {"max_depth": 2, "n_estimators": 2}},
    )
    label = F.col("passed").cast("string").alias("class")
    scored = result.runs["LR"].probabilities.groupBy(label).agg(F.count("*").alias("tested"))
    boosted = result.runs["XGBoost"].results.select(F.inline(F.arrays_zip(F.col("classes").alias("class"), F.col("support").alias("tested"))))
    unknown = spark.createDataFrame([("nothing", n, 0) for n in result.notices], "model string, class string, tested long")
    return (
        scored.select(F.lit("LR").alias("model"), "class", "tested")
        .unionByName(boosted.select(F.lit("XGBoost").alias("model"), "class", "tested"))
        .unionByName(unknown)
    )
