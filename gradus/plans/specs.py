"""Specifications of the modelling input tables: data, not code.

A specification names the base table, the feature tables by refresh cycle and by
source, and the rules that choose columns. ``build_input`` turns one into a lazy
frame over tables handed in by name.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from gradus.operators.assemble import (
    FeatureRules,
    admitted_cohort,
    assemble_features,
    select_sources,
    term_split,
)

# Key and identity columns that are never features. Fixed values.
IDENTITY_COLUMNS = ("person_uid", "id", "puid", "career_account")

# Further columns the course-grade tables leave out. Fixed values.
GRADE_KEY_COLUMNS = (
    "academic_period",
    "aid_year",
    "course_identification",
    "hs_zip",
    "hs_percentile",
    "profile_academic_period",
)

# Network measures per section type the grade table leaves out. Fixed values.
SECTION_MEASURES = (
    "bytes_per_min_in_class_lec",
    "bytes_per_tran_in_class_lec",
    "perc_attendance_lec",
    "avg_arrival_prompt_lec",
    "bytes_per_min_in_class_lab",
    "bytes_per_tran_in_class_lab",
    "perc_attendance_lab",
    "avg_arrival_prompt_lab",
    "bytes_per_min_in_class_rec",
    "bytes_per_tran_in_class_rec",
    "perc_attendance_rec",
    "avg_arrival_prompt_rec",
    "bytes_per_min_in_class_sd",
    "bytes_per_tran_in_class_sd",
    "perc_attendance_sd",
    "avg_arrival_prompt_sd",
    "bytes_per_min_in_class_pso",
    "bytes_per_tran_in_class_pso",
    "perc_attendance_pso",
    "avg_arrival_prompt_pso",
    "bytes_per_min_in_class_lbp",
    "bytes_per_tran_in_class_lbp",
    "perc_attendance_lbp",
    "avg_arrival_prompt_lbp",
)

# Rare or retired tests the grade table leaves out. Fixed values.
RARE_TESTS = (
    "aleks",
    "ap_bio",
    "ap_chin",
    "ap_compgov",
    "ap_compscia",
    "ap_eng_lit",
    "ap_envi",
    "ap_euro",
    "ap_german",
    "ap_hum_geo",
    "ap_japa",
    "ap_physb",
    "ap_physc_elec",
    "ap_physc_mech",
    "ap_psyc",
    "ap_span_lang",
    "ap_span_lit",
    "ap_stat",
    "ap_usgov",
    "ap_world_hist",
)

# Rare schedule mixes the grade table leaves out. Fixed values.
RARE_SCHEDULES = (
    "sched_type_complex_",
    "sched_type_complex_dis",
    "sched_type_complex_lab",
    "sched_type_complex_labdis",
    "sched_type_complex_lablbp",
    "sched_type_complex_labrecdis",
    "sched_type_complex_lecdis",
    "sched_type_complex_leclabdis",
    "sched_type_complex_leclablbp",
    "sched_type_complex_leclabpso",
    "sched_type_complex_leclabrec",
    "sched_type_complex_leclabrecpso",
    "sched_type_complex_lecpso",
    "sched_type_complex_lecpsodis",
    "sched_type_complex_lecrecdis",
    "sched_type_complex_lecrecpso",
    "sched_type_complex_lecrecpsodis",
    "sched_type_complex_lecsd",
    "sched_type_complex_recdis",
    "sched_type_complex_sd",
)

# Patterns of columns left out, searched anywhere in the name. Fixed values.
NATION = r"hs_nation_.*"
STATE = r"hs_state_(?!in|il)[a-z]+"
RACE = r"app_race.+"
RESIDENCY = r"app_residency_.+"
HIGHEST_SAT = r"profile_highest_sat_.+"
PERSON_DETAIL = r"person_detail_.+"
PROFILE_BUT_TERM = r"profile_(?!academic_period).+"

YEAR_LEVEL = "features_financial_aid.feats_from_fin_aid_table_year_level"
GRADE_BASE = "features_dependent_variables.grade_mod_dep_var"
RISK_BASE = "features_dependent_variables.at_risk_dep_var"
ACTIVITY = "features_learning_management.bblearn_student_activity"
APPLICATIONS = "sis.applications"
PROFILE = "features_demographics.feats_from_profile_table"

GRADE_RULES = FeatureRules(
    exclude=(
        *IDENTITY_COLUMNS,
        *GRADE_KEY_COLUMNS,
        *SECTION_MEASURES,
        *RARE_TESTS,
        *RARE_SCHEDULES,
        "earned_points",
        "possible_points",
    ),
    exclude_regex=(NATION, STATE, RACE, RESIDENCY, HIGHEST_SAT, PERSON_DETAIL),
    not_features=(GRADE_BASE, ACTIVITY),
    year_level=(YEAR_LEVEL,),
)

# The general template leaves out identity and key columns only.
TEMPLATE_RULES = replace(GRADE_RULES, exclude=(*IDENTITY_COLUMNS, *GRADE_KEY_COLUMNS))

RISK_RULES_2016 = FeatureRules(
    exclude=(*IDENTITY_COLUMNS, "hs_zip"),
    exclude_regex=(NATION, STATE, PROFILE_BUT_TERM),
    not_features=(RISK_BASE,),
    join_keys=("person_uid",),
)
RISK_RULES_2017 = replace(RISK_RULES_2016, exclude_regex=(NATION, STATE, PROFILE_BUT_TERM, RACE))

PREDICTION_RULES_2016 = FeatureRules(
    exclude=(*IDENTITY_COLUMNS, "hs_zip"),
    exclude_regex=(NATION, STATE),
    not_features=(APPLICATIONS,),
    join_keys=("person_uid",),
)
PREDICTION_RULES_2017 = replace(PREDICTION_RULES_2016, exclude_regex=(NATION, STATE, RACE))


@dataclass(frozen=True)
class InputSpec:
    """What a builder reads, how often it is refreshed, and how it is cut."""

    name: str
    base: str
    rules: FeatureRules
    daily: tuple[str, ...] = ()
    census: tuple[str, ...] = ()
    sources: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    cutoff: int | None = None
    score_terms: tuple[str, ...] = ()
    admitted_terms: tuple[str, ...] = ()
    lower_month: bool = False

    def feature_tables(self, asked: Sequence[str] | None = None) -> list[str]:
        """Tables to join, by source group where the spec has groups."""
        if self.sources:
            return select_sources(self.sources, asked if asked is not None else list(self.sources))
        return [t for t in (*self.daily, *self.census) if t != self.base]


# Demographic tables behind the at-risk builders. Fixed values.
DEMOGRAPHIC_TABLES = (
    "features_demographics.application_demos",
    "features_demographics.application_tests",
    "features_demographics.admission_attributes",
    "features_demographics.admission_decision",
    "features_demographics.high_school",
    "features_demographics.high_school_inst_gpa",
    "features_demographics.high_school_core_gpa",
    "features_demographics.high_school_driving_time",
    "features_demographics.high_school_to_regional_rep_dist",
    "features_demographics.acs_2015_hs_zip",
    "features_demographics.decision_count",
)
DETAIL_2016 = ("features_demographics.feats_from_person_detail_2016_at_risk",)
DETAIL_2017 = ("features_demographics.feats_from_person_detail_table", "features_demographics.admitted_college")


def grade_spec(institution: str = "own") -> InputSpec:
    """Course-grade input. Two table names carry the institution's short name."""
    # Feature tables by source. Fixed values.
    sis = (
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
        f"features_grade.hs_vs_{institution}_gpa_diff",
        "features_grade.repeat_course_ind",
        f"features_grade.prior_{institution}_gpa",
        "features_course_schedule.instructor_difficulty_experience",
        "features_academic_study.num_sems_enrolled",
        "features_academic_study.num_class_min_per_week",
        "features_academic_study.schedule_types",
        "features_academic_study.offering_course",
        "features_grade.important_priors",
    )
    return InputSpec(
        name="grade_mod_input_table",
        base=GRADE_BASE,
        rules=GRADE_RULES,
        daily=(GRADE_BASE, "features_course_schedule.course_size"),
        census=tuple(t for t in sis[1:] if t != "features_grade.important_priors"),
        sources={
            "sis": sis,
            "lms": (
                "features_learning_management.lms_db_msg_posted_asof_4_wk_past",
                "features_learning_management.lms_gradebook_cnt_1st_view_asof_4_wk_past",
                "ip.gradebook_features",
            ),
            "card": (
                "features_card_service.board_plan_rectrac_buddies",
                "features_card_service.weekly_rectrac_swipes",
                "features_card_service.si_sessions",
            ),
            "netlog": ("features_network.attendance_by_person_course",),
        },
        lower_month=True,
    )


AT_RISK_2016 = InputSpec(
    name="at_risk_input_table",
    base=RISK_BASE,
    rules=RISK_RULES_2016,
    daily=(RISK_BASE, *DEMOGRAPHIC_TABLES, *DETAIL_2016),
    census=(PROFILE,),
    cutoff=201610,
    score_terms=("201610",),
)
AT_RISK_2017 = InputSpec(
    name="at_risk_input_table",
    base=RISK_BASE,
    rules=RISK_RULES_2017,
    daily=(RISK_BASE, *DEMOGRAPHIC_TABLES, *DETAIL_2017),
    census=(PROFILE,),
    cutoff=201710,
    score_terms=("201710",),
)
PREDICTION_2016 = InputSpec(
    name="at_risk_201710_pred_table",
    base=APPLICATIONS,
    rules=PREDICTION_RULES_2016,
    daily=(*DEMOGRAPHIC_TABLES, *DETAIL_2016),
    admitted_terms=("201630", "201710"),
)
PREDICTION_2017 = InputSpec(
    name="at_risk_201810_pred_table",
    base=APPLICATIONS,
    rules=PREDICTION_RULES_2017,
    daily=(*DEMOGRAPHIC_TABLES, *DETAIL_2017),
    admitted_terms=("201730", "201810"),
)


def template_spec(base: str, sources: Mapping[str, Sequence[str]], **rules) -> InputSpec:
    """A specification over the user's own tables, with the template's rules."""
    return InputSpec(
        name="input_table",
        base=base,
        rules=replace(TEMPLATE_RULES, **rules),
        sources={k: tuple(v) for k, v in sources.items()},
    )


def build_input(
    spec: InputSpec,
    tables: Mapping[str, DataFrame] | Callable[[str], DataFrame],
    asked: Sequence[str] | None = None,
) -> DataFrame:
    """The assembled table of a specification, lazily."""
    get = tables if callable(tables) else tables.__getitem__
    base = get(spec.base)
    if spec.admitted_terms:
        base = admitted_cohort(base, spec.admitted_terms)
    skipped = set(spec.rules.not_features)
    features = {t: get(t) for t in spec.feature_tables(asked) if t not in skipped}
    return assemble_features(base, features, spec.rules)


def train_and_score(spec: InputSpec, built: DataFrame, term: str = "profile_academic_period") -> tuple[DataFrame, DataFrame]:
    """Training rows and rows to score of an at-risk table."""
    return term_split(built, spec.cutoff, spec.score_terms, term)
