"""Degrees the feed reports: records to update and records to create.

One pipeline for four products. It differs by what counts as a degree (four-year, or
two-year and certificate) and by what is produced (rows for existing records, or for
records that do not exist yet).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.functions.codes import FOUR_YEAR, degree_kind, is_true
from termweave.functions.dates import parse_yyyymmdd
from termweave.functions.degrees import associate_filter, bachelor_filter, classify, major_rules
from termweave.functions.keys import branch_code, first_token
from termweave.operators.importing import import_fields
from termweave.operators.match import matched_records, missing_records
from termweave.operators.rollup import rows_with_lists
from termweave.operators.schools import import_accounts, with_schools
from termweave.operators.terms import with_terms_by_date
from termweave.sources.columns import STATUS_NAME
from termweave.sources.layout import student_key

# Picklist entries that select student records.
ACTIVE = "Active: Post-Secondary"
INACTIVE = "Inactive: Post-Secondary"
COLLEGE_RECORD = "College/University Semester"


@dataclass(frozen=True)
class DegreeSpec:
    """What counts as a degree and what to produce."""

    four_year: bool
    create: bool
    school_levels: tuple[str, ...]
    title_filter: Callable[[Column], Column]
    any_multimedia: bool = False
    # Fixed value: record type of college records.
    record_type_id: str = "01246000000RNnHAAW"


FOUR_YEAR_UPDATE = DegreeSpec(True, False, ("4",), bachelor_filter)
FOUR_YEAR_CREATE = DegreeSpec(True, True, ("4",), bachelor_filter, any_multimedia=True)
TWO_YEAR_UPDATE = DegreeSpec(False, False, ("4", "2", "L"), associate_filter)
TWO_YEAR_CREATE = DegreeSpec(False, True, ("4", "2", "L"), associate_filter)

#: What the products read of the feed.
FEED_COLUMNS = (
    "Requester_Return_Field",
    "Record_Found_Y_N",
    "College_Code_Branch",
    "College_Name",
    "College_State",
    "_2_year___4_year",
    "Graduated_",
    "Graduation_Date",
    "Degree_Title",
    "Degree_Major_1",
)

_STUDENT = ["Contact_Id", "full_name_c", STATUS_NAME, "high_school_graduating_class_c", "site_short"]
_DEGREE = ["nsc_graduation_date", "Degree_Title", "Degree_Major_1"]


def graduates(feed: DataFrame, spec: DegreeSpec) -> DataFrame:
    """Feed rows of degrees of the wanted kind, with cleaned keys and dates."""
    wanted = (
        is_true(F.col("Record_Found_Y_N"))
        & is_true(F.col("Graduated_"))
        & F.col("_2_year___4_year").isin(*spec.school_levels)
        & spec.title_filter(F.col("Degree_Title"))
    )
    return feed.where(wanted).select(
        student_key(feed, "nsc_feed").alias("contact_id_nsc"),
        branch_code(F.col("College_Code_Branch")).alias("nsc_college_code_branch"),
        F.col("College_Name").alias("nsc_college_name"),
        "College_State",
        parse_yyyymmdd(F.col("Graduation_Date")).alias("nsc_graduation_date"),
        "Degree_Title",
        "Degree_Major_1",
    )


def college_records(student_terms: DataFrame, spec: DegreeSpec) -> DataFrame:
    """Student-term records that a degree can go to or that show it is known."""
    wanted = (
        F.col("indicator_completed_ct_hs_program_c")
        & F.col(STATUS_NAME).isin(ACTIVE, INACTIVE)
        & (F.col("AT_record_type_name") == COLLEGE_RECORD)
    )
    if spec.four_year:
        wanted &= F.col("graduated_4_year_degree_c") == F.lit(False)
    elif not spec.create:
        wanted &= F.col("type_of_degree_earned_c").isNull()
    return student_terms.where(wanted).select(
        *_STUDENT,
        "AT_Id",
        "AT_Name",
        "AT_School_Name",
        "AT_Enrollment_Status_c",
        "indicator_years_since_hs_graduation_c",
        "type_of_degree_earned_c",
        F.col("GAS_Name").alias("record_term_name"),
        F.col("global_academic_semester_c").alias("PAT_GAS_id"),
        student_key(student_terms, "student_term").alias("contact_id_mod"),
    )


def calendars_agree(spec: DegreeSpec) -> Column:
    """Whether the term's calendar fits the college's.

    For an existing record a quarter record of a semester college will do as well, for
    active students too.
    """
    same = F.col("GAS_calendar") == F.col("college_academic_calendar")
    if spec.create:
        return same
    quarter = (F.col("college_academic_calendar") == "Semester") & F.col("AT_Name").contains("Quarter")
    return same | quarter


def _update_candidates(feed, student_terms, schools, scorecard, terms, spec) -> DataFrame:
    mapped = with_terms_by_date(graduates(feed, spec), terms, "nsc_graduation_date")
    records = college_records(student_terms, spec).drop("type_of_degree_earned_c")
    matched = matched_records(records, mapped)
    record_columns = (
        ["AT_School_Name", "indicator_years_since_hs_graduation_c"]
        if spec.four_year
        else ["AT_Enrollment_Status_c"]
    )
    return (
        with_schools(matched, schools, scorecard)
        .where(calendars_agree(spec))
        .select(
            *_STUDENT,
            "AT_Id",
            "AT_Name",
            "PAT_GAS_id",
            "record_term_name",
            *record_columns,
            "nsc_college_name",
            "college_academic_calendar",
            "GAS_calendar",
            "cs_ipeds_id",
            "account_id",
            *_DEGREE,
        )
        .distinct()
    )


def _create_candidates(feed, student_terms, schools, scorecard, terms, spec) -> DataFrame:
    mapped = with_terms_by_date(graduates(feed, spec), terms, "nsc_graduation_date")
    records = college_records(student_terms, spec)
    # Records that hold a degree already still count as matches, but open no new one. A student's
    # terms are gathered once, and both what is open and what matches is read from there.
    is_open = F.lit(True) if spec.four_year else F.col("type_of_degree_earned_c").isNull()
    by_student = records.groupBy(*_STUDENT, "contact_id_mod").agg(
        F.collect_set(F.struct("PAT_GAS_id", is_open.alias("open"))).alias("_terms")
    )
    students = by_student.where(F.exists("_terms", lambda t: t["open"])).drop("_terms")
    records = by_student.select("contact_id_mod", F.explode("_terms.PAT_GAS_id").alias("PAT_GAS_id"))
    return (
        with_schools(missing_records(students, mapped, records), schools, scorecard)
        .where((F.col("College_State") == F.col("billing_state_code")) & calendars_agree(spec))
        .select(
            *_STUDENT,
            "GAS_id",
            "GAS_Name",
            "GAS_calendar",
            "academic_year_c",
            "nsc_college_name",
            "college_academic_calendar",
            "rank_college_type",
            "cs_ipeds_id",
            "account_id",
            "account_name",
            *_DEGREE,
        )
        .distinct()
    )


def degree_records(
    feed: DataFrame,
    student_terms: DataFrame,
    schools: DataFrame,
    scorecard: DataFrame,
    terms: DataFrame,
    spec: DegreeSpec,
) -> DataFrame:
    """Import rows for the degrees of the feed, per ``spec``."""
    candidates = _create_candidates if spec.create else _update_candidates
    degrees = candidates(feed, student_terms, schools, scorecard, terms, spec).withColumns(
        {
            "sfdc_major": classify(F.col("Degree_Major_1"), major_rules(spec.any_multimedia)),
            "sfdc_degree": degree_kind(F.col("Degree_Title")),
            "date_text": F.col("nsc_graduation_date").cast("string"),
        }
    )
    keys = ["GAS_id", "Contact_Id"] if spec.create else ["AT_Id"]

    # Each account of the college's IPEDS id makes a row, so a degree stands in the lists
    # once per account.
    per_college = (
        schools.where("ipeds_id_c IS NOT NULL")
        .groupBy(F.col("ipeds_id_c").alias("counted_ipeds"))
        .agg(F.count(F.lit(1)).alias("n_accounts"))
    )
    weighted = degrees.join(per_college, F.col("cs_ipeds_id") == F.col("counted_ipeds")).drop("counted_ipeds")
    best = {}
    if not spec.four_year:
        best["best_degree"] = "sfdc_degree"
        if spec.create:
            best["best_type"] = "rank_college_type"
    rows = rows_with_lists(
        weighted,
        keys,
        order=_DEGREE,
        lists={
            "list_sfdc_major": "sfdc_major",
            "list_sfdc_degrees": "sfdc_degree",
            "list_nsc_degree": "Degree_Title",
            "list_nsc_major": "Degree_Major_1",
            "list_nsc_grad_date": "date_text",
        },
        by_value=("list_sfdc_degrees",),
        best=best,
        copies="n_accounts",
    )
    rows = rows.join(import_accounts(schools), F.col("cs_ipeds_id") == F.col("for_prod_ipeds"))
    fields = _create_fields(spec) if spec.create else _update_fields(spec)
    return import_fields(rows, fields).distinct()


def _degree_earned(spec: DegreeSpec) -> Column:
    return F.lit(FOUR_YEAR) if spec.four_year else first_token(F.col("list_sfdc_degrees"))


def _update_fields(spec: DegreeSpec) -> list[tuple[str, str | Column]]:
    who = [(c, c) for c in ("Contact_Id", "full_name_c", "site_short", "for_prod_college_name")]
    record = [("AT_Name", "AT_Name"), ("PAT_GAS_id", "PAT_GAS_id")]
    majors = [("list_sfdc_major", "list_sfdc_major")]
    degrees = [("list_sfdc_degrees", "list_sfdc_degrees")]
    return [
        *who,
        *(majors + record if spec.four_year else record + degrees + majors),
        ("nsc_graduation_date", "nsc_graduation_date"),
        ("nsc_college_name", "nsc_college_name"),
        ("nsc_degree", "list_nsc_degree"),
        ("nsc_major", "list_nsc_major"),
        ("Id", "AT_Id"),
        ("School__c", "for_prod_account_id"),
        ("Major__c", first_token(F.col("list_sfdc_major"))),
        (
            "Type_of_Degree_Earned__c" if spec.four_year else "type_of_degree_earned_c",
            _degree_earned(spec),
        ),
    ]


def _create_fields(spec: DegreeSpec) -> list[tuple[str, str | Column]]:
    who = [(c, c) for c in ("full_name_c", "site_short", "for_prod_college_name")]
    if spec.four_year:
        who.append(("list_sfdc_major", "list_sfdc_major"))
    graduated = first_token(F.col("list_nsc_grad_date")) if spec.four_year else "nsc_graduation_date"
    return [
        *who,
        ("GAS_Name", "GAS_Name"),
        ("nsc_graduation_date", graduated),
        ("nsc_college_name", "nsc_college_name"),
        ("nsc_degree" if spec.four_year else "nsc_degree_earned", "list_nsc_degree"),
        ("nsc_major", "list_nsc_major"),
        ("Student__c", "Contact_Id"),
        ("student_audit_status__c", STATUS_NAME),
        ("ct_status_at_c", STATUS_NAME),
        ("RecordTypeId", F.lit(spec.record_type_id)),
        ("Global_Academic_Semester__c", "GAS_id"),
        ("Academic_Year__c", "academic_year_c"),
        ("Name", F.concat("GAS_Name", F.lit(" "), "full_name_c")),
        ("School__c", "for_prod_account_id"),
        ("Major__c", first_token(F.col("list_sfdc_major"))),
        ("Type_of_Degree_Earned__c", _degree_earned(spec)),
    ]
