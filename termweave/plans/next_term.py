"""Records of the next term, rolled forward from the current one."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.functions.carry import filled_when, null_when
from termweave.functions.codes import CALENDAR_ERROR, calendar_of_name
from termweave.operators.audit import record_count_audit, term_count_rows, term_counts
from termweave.operators.importing import import_fields
from termweave.operators.sizes import small
from termweave.sources.columns import STATUS_CODE
from termweave.sources.schemas import RUBRIC_CARRIED, RUBRIC_RESET
from termweave.sources.sinks import write_import

# Status codes of active, inactive and alumni students.
ACTIVE, INACTIVE, ALUMNI = "15A", "16A", "17A"

# Fixed value: years after high school from which non-active students are left out.
MAX_YEARS = 5.99

# Terms without an advising rubric, by rubric.
RUBRIC_FREE_TERMS = {
    "missing_advising_rubric_career_v_2_c": ["Winter", "Summer"],
    "missing_advising_rubric_financial_v_2_c": ["Summer"],
    "missing_advising_rubric_wellness_v_2_c": ["Summer"],
    "missing_advising_rubric_academic_v_2_c": ["Summer"],
}


@dataclass(frozen=True)
class TermSpec:
    """The term to create: its season and the day it starts."""

    season: str
    start_date: date
    # Fixed value: record type of college records.
    record_type_id: str = "01246000000RNnHAAW"
    academic_level: str = "Undergraduate"


def current_records(student_terms: DataFrame) -> DataFrame:
    """Current records of active students, and of the others while they are young enough."""
    young = F.col("indicator_years_since_hs_graduation_c") < F.lit(MAX_YEARS)
    status = F.col(STATUS_CODE)
    return student_terms.where(
        F.col("current_as_c") & ((status == ACTIVE) | (status.isin(INACTIVE, ALUMNI) & young))
    ).withColumn("school_calendar", calendar_of_name(F.col("AT_Name")))


def unknown_calendars(student_terms: DataFrame) -> DataFrame:
    """Current records that no term can be found for, because their name gives no calendar."""
    return current_records(student_terms).where(F.col("school_calendar") == CALENDAR_ERROR)


def next_term_records(student_terms: DataFrame, terms: DataFrame, spec: TermSpec) -> DataFrame:
    """Records to create for the next term, except for students who are in it already."""
    target = terms.where(F.col("GAS_start_date") == F.lit(spec.start_date)).select(
        "GAS_id",
        "academic_year_c",
        F.col("GAS_Name").alias("gas_name_to_create"),
        F.col("term_c").alias("season_to_create"),
        "academic_calendar_category_c",
    )
    # Records without a known calendar match no term; ``unknown_calendars`` counts them.
    rows = (
        current_records(student_terms)
        .where(F.col("school_calendar") != CALENDAR_ERROR)
        .drop("term_c")
        .join(small(target), F.col("school_calendar") == F.col("academic_calendar_category_c"))
        .where(F.col("GAS_Name") != F.col("gas_name_to_create"))
    )
    status = F.col(STATUS_CODE)
    fall = F.lit(spec.season == "Fall")
    not_active, alumni = status != ACTIVE, status == ALUMNI
    enrolment = filled_when(
        F.col("enrollment_status_c"), fall, F.col("persistence_at_prev_enrollment_status_c")
    )
    majors = ["major_c", "major_other_c", "second_major_c", "minor_c"]
    return import_fields(
        rows,
        [
            ("gas_name_to_create", "gas_name_to_create"),
            ("contact_id", "Contact_Id"),
            (STATUS_CODE, STATUS_CODE),
            ("previous_academic_semester_c", "AT_Id"),
            ("academic_year_c", "academic_year_c"),
            ("GAS_id", "GAS_id"),
            *[(c, null_when(F.col(c), not_active)) for c in majors],
            ("enrollment_status_c", null_when(enrolment, not_active)),
            (
                "Cumulative_Credits_Awarded_All_Terms",
                null_when(F.col("cumulative_credits_awarded_most_recent_c"), status != INACTIVE),
            ),
            *[(c, null_when(F.col(c), alumni)) for c in ("school_c", "cc_advisor_at_user_id_c")],
            *[
                (
                    rubric,
                    F.when(F.col("season_to_create").isin(free), False).otherwise(True),
                )
                for rubric, free in RUBRIC_FREE_TERMS.items()
            ],
            *[(c, c) for c in RUBRIC_CARRIED],
            (RUBRIC_RESET[0], null_when(F.col(RUBRIC_RESET[0]), fall)),
            ("filing_status__c", null_when(F.col(RUBRIC_RESET[1]), fall)),
            ("record_type_id", F.lit(spec.record_type_id)),
        ],
    )


def current_enrolments(enrolments: DataFrame) -> DataFrame:
    """Current enrolments of active college students, and of the others while they are young enough."""
    status, phase = F.col("current_ct_status_c"), F.col("current_ct_phase_c")
    young = F.col("years_since_high_school_graduation_ate_c") < F.lit(MAX_YEARS)
    in_college = phase == "Post Secondary"
    return enrolments.where(
        F.col("current_at_c")
        & (
            ((status == "Active") & in_college)
            | ((status == "Inactive") & in_college & young)
            | ((phase == "Alumni") & young)
        )
    ).drop("at_id", "at_name")


def target_terms(terms: DataFrame, spec: TermSpec) -> DataFrame:
    """The new CRM's terms that start on the day of the spec."""
    return terms.select(
        "at_id",
        "ay_id",
        F.col("at_name").alias("at_name_to_create"),
        "academic_calendar_c",
        F.col("at_start_date").cast("date").alias("enrollment_date"),
        F.col("at_end_date").cast("date").alias("exit_date"),
    ).where(F.col("enrollment_date") == F.lit(spec.start_date))


def unmatched_calendars(enrolments: DataFrame, terms: DataFrame, spec: TermSpec) -> DataFrame:
    """Current enrolments whose calendar no target term has, so that no enrolment is created."""
    known = small(target_terms(terms, spec).select("academic_calendar_c").distinct())
    return current_enrolments(enrolments).join(
        known, F.col("academic_calendar_ate_c") == F.col("academic_calendar_c"), "left_anti"
    )


def next_term_enrolments(
    enrolments: DataFrame,
    scholars: DataFrame,
    terms: DataFrame,
    year_enrolments: DataFrame,
    spec: TermSpec,
) -> DataFrame:
    """Enrolments to create for the next term in the new CRM."""
    status, phase = F.col("current_ct_status_c"), F.col("current_ct_phase_c")
    target = target_terms(terms, spec)
    current = current_enrolments(enrolments)
    credits = scholars.select(
        F.col("account_id").alias("scholar_id"), "most_recent_num_cumulative_credits_pc"
    )
    years = year_enrolments.select(
        F.col("aye_id").alias("academic_year_enrollment_c"),
        F.col("ay_id").alias("enrolled_year"),
        F.col("account_id").alias("enrolled_account"),
    )
    # The term lookup drops rows, so it comes before the lookups that shuffle.
    rows = (
        current.join(small(target), F.col("academic_calendar_ate_c") == F.col("academic_calendar_c"))
        .join(credits, F.col("account_id") == F.col("scholar_id"), "left")
        .join(
            years,
            (F.col("account_id") == F.col("enrolled_account"))
            & (F.col("ay_id") == F.col("enrolled_year")),
            "left",
        )
    )
    not_active, alumni = status != "Active", phase == "Alumni"
    majors = ["major_category_c", "major_c", "second_major_category_c", "second_major_c", "minor_c"]
    return import_fields(
        rows,
        [
            ("at_name_to_create", "at_name_to_create"),
            ("account_id", "account_id"),
            ("ct_status_ate_c", "ct_status_ate_c"),
            ("previous_academic_term_enrollment_c", "ate_id"),
            ("academic_year_enrollment_c", "academic_year_enrollment_c"),
            ("at_id", "at_id"),
            ("ay_id", "ay_id"),
            ("student_academic_level", F.lit(spec.academic_level)),
            ("ct_case_c", "ct_case_c"),
            ("contact_id", "contact_id"),
            ("owner_id", "owner_id"),
            ("enrollment_date", "enrollment_date"),
            ("exit_date", "exit_date"),
            ("concurrent_school_enrolled_c", "concurrent_school_enrolled_c"),
            *[(c, null_when(F.col(c), not_active)) for c in majors],
            ("enrollment_status", null_when(F.col("ate_enrollment_status"), not_active)),
            (
                "cumulative_credits_awarded_all_terms_c",
                null_when(F.col("most_recent_num_cumulative_credits_pc"), not_active),
            ),
            ("school_c", null_when(F.col("ate_school_id"), alumni)),
            ("ct_coach_ate_c", null_when(F.col("ct_coach_ate_c"), alumni)),
        ],
    )


def write_next_term(
    records: DataFrame, terms: DataFrame, spec: TermSpec, path: str, fmt: str = "parquet"
) -> DataFrame:
    """Writes next-term records, and returns their ``next_term_audit``, counted as they are written.

    The names of the terms to create are the calendar's that start on the day of the spec, so a
    handful; the product itself runs once.
    """
    days = terms.where(F.col("GAS_start_date") == F.lit(spec.start_date))
    names = sorted(r[0] for r in days.select("GAS_Name").distinct().collect() if r[0] is not None)
    seen = write_import(records, path, fmt, term_counts("gas_name_to_create", "contact_id", names))
    return term_count_rows(records.sparkSession, seen, "gas_name_to_create", names)


def next_term_audit(records: DataFrame) -> DataFrame:
    """Students and records per term to create, of either CRM's product."""
    old, new = "gas_name_to_create", "at_name_to_create"
    return record_count_audit(records, old if old in records.columns else new, "contact_id")
