"""Enrolment spans of the feed against the status on the student's record."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.functions.codes import (
    ENROLLED_CODES,
    FULL_TIME,
    PART_TIME,
    decode_class,
    decode_status,
    is_true,
)
from termweave.functions.dates import parse_yyyymmdd, span_label
from termweave.functions.keys import branch_code
from termweave.operators.importing import import_fields
from termweave.operators.schools import scorecard_codes
from termweave.operators.terms import (
    nearest_terms_by_span,
    term_match_counts,
    with_best_term_by_span,
    with_best_term_names,
)
from termweave.plans.degrees import COLLEGE_RECORD
from termweave.sources.columns import STATUS_NAME
from termweave.sources.layout import student_key

BEGIN, END = "nsc_enrollment_start", "nsc_enrollment_end"

_MAJORS = ["Enrollment_Major_1", "Enrollment_Major_2"]
_DEGREES = [
    "Graduated_",
    "Graduation_Date",
    "Degree_Title",
    "Degree_Major_1",
    "Degree_Major_2",
    "Degree_Major_3",
    "Degree_Major_4",
]
_RECORD = [
    "Contact_Id",
    "AT_Id",
    "full_name_c",
    "high_school_graduating_class_c",
    "site_short",
    STATUS_NAME,
    "years_since_hs_grad_c",
    "academic_year_4_year_degree_earned_c",
    "AT_Name",
    "AT_Enrollment_Status_c",
    "AT_School_Name",
    "school_account_18_id_c",
    "cc_advisor_c",
    "GAS_start_date",
    "GAS_end_date",
    "GAS_Name",
    "term_c",
    "AY_Name",
    "global_academic_semester_c",
]


def enrolled(feed: DataFrame) -> DataFrame:
    """Feed rows of full- and part-time enrolments, decoded."""
    wanted = is_true(F.col("Record_Found_Y_N")) & F.col("Enrollment_Status").isin(ENROLLED_CODES)
    parsed = feed.where(wanted).withColumns(
        {
            BEGIN: parse_yyyymmdd(F.col("Enrollment_Begin")),
            END: parse_yyyymmdd(F.col("Enrollment_End")),
        }
    )
    return parsed.select(
        student_key(feed, "nsc_feed").alias("contact_id_nsc"),
        F.col("First_Name").alias("first_name_nsc"),
        F.col("Last_Name").alias("last_name_nsc"),
        "Record_Found_Y_N",
        "Search_Date",
        branch_code(F.col("College_Code_Branch")).alias("nsc_college_code_branch"),
        "College_Name",
        "College_State",
        "_2_year___4_year",
        "Public___Private",
        BEGIN,
        END,
        span_label(F.col(BEGIN), F.col(END)).alias("nsc_date_concat"),
        F.year(BEGIN).alias("nsc_Year"),
        F.col("Enrollment_Status").alias("nsc_enrollment_status"),
        decode_status(F.col("Enrollment_Status")).alias("nsc_enrollment_status_ft_pt"),
        "College_Sequence",
        "Class_Level",
        decode_class(F.col("Class_Level")).alias("Class"),
        *_MAJORS,
        *_DEGREES,
    )


def _records(student_terms: DataFrame) -> DataFrame:
    return student_terms.where(F.col("AT_record_type_name") == COLLEGE_RECORD)


def _student_states(student_terms: DataFrame) -> DataFrame:
    """The statuses and ages that a student's records show; one feed row stands for each."""
    return (
        _records(student_terms)
        .select(
            student_key(student_terms, "student_term").alias("state_contact"),
            F.col(STATUS_NAME).alias("sfdc_ct_status"),
            F.col("years_since_hs_grad_c").alias("sfdc_years_since_hs_grad"),
        )
        .distinct()
    )


def _records_with_school(student_terms: DataFrame, schools: DataFrame, terms: DataFrame) -> DataFrame:
    calendars = terms.select(F.col("GAS_id").alias("calendar_id"), "academic_calendar_category_c")
    accounts = schools.select(
        F.col("account_id").alias("record_account"),
        "ipeds_id_c",
        "school_permanently_closed_c",
        F.col("academic_calendar_value_c").alias("sfdc_college_academic_calendar"),
    )
    # The later comparison of IPEDS ids needs an account, so these lookups are inner.
    return (
        _records(student_terms)
        .select(*_RECORD, student_key(student_terms, "student_term").alias("contact_id_mod"))
        .join(calendars, F.col("global_academic_semester_c") == F.col("calendar_id"))
        .join(accounts, F.col("school_account_18_id_c") == F.col("record_account"))
        .drop("calendar_id", "record_account")
    )


def enrolment_discrepancies(
    feed: DataFrame,
    student_terms: DataFrame,
    schools: DataFrame,
    scorecard: DataFrame,
    terms: DataFrame,
    users: DataFrame,
    same_college: bool = True,
) -> DataFrame:
    """Records that show no enrolment for a term the feed reports one for.

    With ``same_college`` the record names the feed's college; without, it names another one,
    and an indicator tells whether the statuses differ.
    """
    spans = with_best_term_by_span(enrolled(feed), terms, BEGIN, END)
    codes = scorecard_codes(scorecard)
    spans = spans.join(codes, F.col("nsc_college_code_branch") == codes.cs_college_branch_code_6)

    not_enrolled = ~F.col("AT_Enrollment_Status_c").isin(FULL_TIME, PART_TIME)
    records = _records_with_school(student_terms, schools, terms).where(not_enrolled)
    college = F.col("ipeds_id_c") == F.col("cs_ipeds_id")
    found = records.join(
        spans,
        (F.col("contact_id_mod") == F.col("contact_id_nsc"))
        & (F.col("global_academic_semester_c") == F.col("GAS_id"))
        & (college if same_college else ~college),
    )
    # Whoever has a record has a state, so the lookup of states is inner. States are distinct, so
    # rows are made distinct before they are multiplied by them.
    rows = found.distinct().join(
        _student_states(student_terms), F.col("contact_id_nsc") == F.col("state_contact")
    )
    advisors = users.select("user_id", F.col("user_name"), "is_active")
    rows = rows.join(advisors, F.col("cc_advisor_c") == F.col("user_id"), "left")
    return import_fields(rows, _discrepancy_fields(same_college))


def _discrepancy_fields(same_college: bool):
    differs = F.col("nsc_enrollment_status_ft_pt") != F.col("AT_Enrollment_Status_c")
    indicator = [("indicator_enrollment_discr", F.when(differs, 1).otherwise(0))]
    same_name = [
        "Contact_Id",
        "AT_Id",
        "full_name_c",
        "high_school_graduating_class_c",
        "site_short",
        STATUS_NAME,
        "years_since_hs_grad_c",
        "academic_year_4_year_degree_earned_c",
        "AT_Name",
        BEGIN,
        END,
        "AT_School_Name",
    ]
    statuses = [
        "AT_Enrollment_Status_c",
        "nsc_enrollment_status",
        "nsc_enrollment_status_ft_pt",
        "nsc_Year",
        "Class_Level",
        "Class",
    ]
    terms_and_schools = [
        "sfdc_college_academic_calendar",
        "academic_calendar_category_c",
        "GAS_start_date",
        "GAS_end_date",
        "GAS_Name",
        "school_account_18_id_c",
        "school_permanently_closed_c",
    ]
    return [
        *([] if same_college else indicator),
        *[(c, c) for c in same_name],
        ("nsc_college_name", "College_Name"),
        *[(c, c) for c in statuses + _MAJORS + _DEGREES],
        ("cc_advisor", "user_name"),
        ("active_user", "is_active"),
        ("cc_advisor_user_id", "cc_advisor_c"),
        *[(c, c) for c in terms_and_schools],
    ]


def span_term_counts(feed: DataFrame, terms: DataFrame) -> DataFrame:
    """Number of candidate terms per enrolment span and short term name."""
    spans = nearest_terms_by_span(enrolled(feed), terms, BEGIN, END)
    return term_match_counts(spans, BEGIN, END)


def feed_to_term_short(
    feed: DataFrame, student_terms: DataFrame, scorecard: DataFrame, terms: DataFrame
) -> DataFrame:
    """Enrolments with the short name of their best terms and how many terms share it."""
    codes = scorecard_codes(scorecard)
    spans = with_best_term_names(enrolled(feed), terms, BEGIN, END)
    term_columns = ["GAS_Name_short", "num_terms", "start_rank", "end_rank"]
    rows = (
        spans.join(
            _student_states(student_terms),
            F.col("contact_id_nsc") == F.col("state_contact"),
            "left",
        )
        .drop("state_contact")
        .join(codes, F.col("nsc_college_code_branch") == codes.cs_college_branch_code_6, "left")
    )
    return rows.select(*[c for c in rows.columns if c not in term_columns], *term_columns).distinct()
