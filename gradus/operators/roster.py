"""Cohort lists: test scores per person, the roster, and what changed between two."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.functions import normalize_id
from gradus.operators.assemble import ADMITTED, admitted_applications
from gradus.session import broadcast_if_small, materialise

# Test codes behind each best score. Fixed values.
BEST_SCORES = {
    "satm": "S02",
    "satv": "S01",
    "satw": "S07",
    "acte": "A01",
    "actm": "A02",
    "act_comp": "A05",
    "actr": "A03",
    "actew": "A07",
    "toefl": "TIBT",
}

# Test codes summed on one day before the best day is taken. Fixed values.
DAY_SUMS = {"sat_total": ("S01", "S02"), "acter": ("A01", "A03")}

# Cohort that marks a summer start. Fixed value.
SUMMER_COHORT = "SUMMERSTRT"


def test_score_pivot(
    scores: DataFrame,
    best: Mapping[str, str] = BEST_SCORES,
    day_sums: Mapping[str, Sequence[str]] = DAY_SUMS,
    score_type: str = "double",
) -> DataFrame:
    """One row per person: best score of each test and best same-day sums.

    Scores are first reduced per person and day, which a hot person shares over
    many days, then per person. Both levels combine before their shuffle.
    """
    value = F.col("test_score").cast(score_type)

    def of(tests: Sequence[str]) -> Column:
        return F.when(F.col("test").isin(*tests), value)

    per_day = scores.groupBy("person_uid", "test_date").agg(
        *[F.max(of([code])).alias(name) for name, code in best.items()],
        *[F.sum(of(codes)).alias(name) for name, codes in day_sums.items()],
    )
    return per_day.groupBy("person_uid").agg(*[F.max(n).alias(n) for n in (*best, *day_sums)])


# Output columns of the roster after the first four, with the side they come
# from: application, prediction table, person or test scores. Fixed values.
_ROSTER = [
    ("person", "last_name", "last_name"),
    ("person", "first_name", "first_name"),
    ("person", "middle_initial", "middle_initial"),
    ("application", "major_desc", "major"),
    ("features", "hs_gpa", "high_school_gpa"),
    ("features", "hs_core_gpa", "high_school_core_gpa"),
    ("application", "residency", "residency"),
    ("person", "nation_of_citizenship_desc", "nation_of_citizenship"),
    ("person", "gender", "gender"),
    ("person", "underrepresented_minority_ind", "underrepresented_minority_ind"),
    ("person", "reporting_ethnicity", "reporting_ethnicity"),
    ("tests", "satm", "satm"),
    ("tests", "satv", "satv"),
    ("tests", "satw", "satw"),
    ("tests", "sat_total", "sat_total"),
    ("tests", "acte", "acte"),
    ("tests", "actm", "actm"),
    ("tests", "actr", "actr"),
    ("tests", "actew", "actew"),
    ("tests", "acter", "acter"),
    ("tests", "act_comp", "act_comp"),
    ("tests", "toefl", "toefl"),
]


def risk_roster(
    predictions: DataFrame,
    applications: DataFrame,
    features: DataFrame,
    persons: DataFrame,
    scores: DataFrame,
    cohorts: DataFrame,
    terms: Sequence[str],
    predicted: str = "class_label_predicted",
    probs: str = "class_label_proba_predicted",
    at_risk: str = "1",
    fixed: Mapping = ADMITTED,
) -> DataFrame:
    """Admitted persons predicted at risk, 26 columns, by college and probability."""
    flagged = predictions.where(F.col(predicted).cast("string") == at_risk).select(
        normalize_id(F.col("person_uid")).alias("person_uid"),
        F.element_at(probs, 2).alias("predicted_at_risk_probability"),
    )

    def side(df: DataFrame, name: str, extra: Sequence[Column] = ()) -> DataFrame:
        wanted = [F.col(src).alias(f"{name}.{src}") for s, src, _ in _ROSTER if s == name]
        return df.select(F.col("person_uid").cast("string").alias("person_uid"), *wanted, *extra)

    admitted = side(
        admitted_applications(applications, terms, fixed),
        "application",
        [F.col("college_desc").alias("college"), F.col("id").cast("string").alias("puid")],
    )
    summer = cohorts.where(F.col("cohort") == SUMMER_COHORT).select(
        F.col("person_uid").cast("string").alias("person_uid"), F.lit("Y").alias("_summer")
    )
    # Persons first: these sides hold a person once, while a person may hold
    # very many applications. The finished profiles are written, then broadcast
    # if few; otherwise the join shuffles and its hot partitions are split.
    profiles = (
        flagged.join(side(features, "features"), "person_uid", "left")
        .join(side(persons, "person"), "person_uid", "left")
        .join(side(test_score_pivot(scores), "tests"), "person_uid", "left")
        .join(summer, "person_uid", "left")
    )
    joined = admitted.join(broadcast_if_small(materialise(profiles)), "person_uid")
    return joined.select(
        "college",
        "predicted_at_risk_probability",
        F.coalesce("_summer", F.lit("N")).alias("summer_start_ind"),
        "puid",
        *[F.col(f"`{s}.{src}`").alias(out) for s, src, out in _ROSTER],
    ).orderBy("college", F.col("predicted_at_risk_probability").desc_nulls_first(), "puid")


def list_added(current: DataFrame, previous: DataFrame, key: str = "puid") -> DataFrame:
    """Rows of the current list whose key the previous list lacks."""
    return current.join(previous.select(key), key, "left_anti").select(*current.columns)


def list_removed(current: DataFrame, previous: DataFrame, key: str = "puid") -> DataFrame:
    """Rows of the previous list whose key the current list lacks."""
    return list_added(previous, current, key)


def _persons_on(listed: DataFrame, lookup: DataFrame) -> DataFrame:
    return listed.select("puid").join(lookup.select("puid", "person_uid"), "puid")


def applications_absent_from(
    listed: DataFrame, lookup: DataFrame, cohort: DataFrame, applications: DataFrame, terms: Sequence[str]
) -> DataFrame:
    """Applications, in the terms, of listed persons whom a cohort table lacks."""
    absent = _persons_on(listed, lookup).join(cohort.select("person_uid"), "person_uid", "left_anti")
    in_terms = applications.where(F.col("academic_period").isin(*terms))
    ids = broadcast_if_small(materialise(absent.select(F.col("puid").alias("_puid"))))
    return in_terms.join(ids, in_terms["id"] == ids["_puid"]).select(*[in_terms[c] for c in in_terms.columns])


def added_by_admission(
    current_list: DataFrame, lookup: DataFrame, previous_cohort: DataFrame, applications: DataFrame, terms: Sequence[str]
) -> DataFrame:
    """Listed now because they were not yet in the previous cohort."""
    return applications_absent_from(current_list, lookup, previous_cohort, applications, terms)


def removed_by_cancellation(
    previous_list: DataFrame, lookup: DataFrame, current_cohort: DataFrame, applications: DataFrame, terms: Sequence[str]
) -> DataFrame:
    """Listed before and gone because they left the current cohort."""
    return applications_absent_from(previous_list, lookup, current_cohort, applications, terms)


def changed_records(
    changed_list: DataFrame,
    other_list: DataFrame,
    lookup: DataFrame,
    previous_cohort: DataFrame,
    current_cohort: DataFrame,
    previous_day: date,
    current_day: date,
) -> DataFrame:
    """Both versions of the persons only one list has, where both cohorts hold them."""
    only = list_added(changed_list, other_list).select("puid")
    persons = _persons_on(only, lookup)
    kept = persons.join(previous_cohort.select("person_uid"), "person_uid", "left_semi").join(
        current_cohort.select("person_uid"), "person_uid", "left_semi"
    )
    kept = broadcast_if_small(materialise(kept))

    def version(cohort: DataFrame, day: date) -> DataFrame:
        return cohort.join(kept, "person_uid").select(
            F.lit(day).alias("dt_created"), *cohort.columns, "puid"
        )

    both = version(previous_cohort, previous_day).unionByName(version(current_cohort, current_day))
    return both.distinct().orderBy("puid", "dt_created")
