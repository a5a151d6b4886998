from datetime import date

import pytest

from termweave.plans.next_term import (
    TermSpec,
    next_term_audit,
    next_term_enrolments,
    next_term_records,
    unknown_calendars,
)
from termweave.sources.columns import STATUS_CODE
from tests.fixtures import TERMS, frame, record

FALL = TermSpec("Fall", date(2022, 8, 1))
SPRING = TermSpec("Spring", date(2022, 1, 1))
FIELDS = {
    "major_c": "M", "minor_c": "N", "school_c": "A1", "cc_advisor_at_user_id_c": "U1",
    "cumulative_credits_awarded_most_recent_c": 12.0, "enrollment_status_c": None,
    "persistence_at_prev_enrollment_status_c": "Part-time", "loan_exit_c": "L",
    "financial_aid_package_c": "F", "filing_status_c": "G",
}


def run(spark, spec, records):
    return next_term_records(
        frame(spark, "student_term", records), frame(spark, "term", TERMS), spec
    )


def test_active_student_in_fall(spark):
    (row,) = run(spark, FALL, [record("s1", "SS", **FIELDS)]).collect()
    assert row.gas_name_to_create == "Fall 2022 (Semester)"
    assert row.previous_academic_semester_c == "s1-SS"
    assert (row.major_c, row.minor_c, row.school_c, row.loan_exit_c) == ("M", "N", "A1", "L")
    assert row.enrollment_status_c == "Part-time"
    assert row.Cumulative_Credits_Awarded_All_Terms is None
    assert (row.financial_aid_package_c, row.filing_status__c) == (None, None)
    assert row.missing_advising_rubric_career_v_2_c is True
    assert len(row) == 31


@pytest.mark.parametrize(
    "status, major, credits, school",
    [("15A", "M", None, "A1"), ("16A", None, 12.0, "A1"), ("17A", None, None, None)],
)
def test_carry_over_by_status(spark, status, major, credits, school):
    fields = FIELDS | {STATUS_CODE: status, "indicator_years_since_hs_graduation_c": 5.98}
    (row,) = run(spark, SPRING, [record("s1", "FS", **fields)]).collect()
    assert (row.major_c, row.Cumulative_Credits_Awarded_All_Terms) == (major, credits)
    assert (row.school_c, row.cc_advisor_at_user_id_c) == (school, school and "U1")
    assert row.enrollment_status_c is None
    assert (row.financial_aid_package_c, row.filing_status__c) == ("F", "G")


@pytest.mark.parametrize(
    "change",
    [
        {STATUS_CODE: "16A", "indicator_years_since_hs_graduation_c": 5.99},
        {STATUS_CODE: "17A", "indicator_years_since_hs_graduation_c": None},
        {STATUS_CODE: "18A"},
        {STATUS_CODE: None},
        {"current_as_c": False},
        {"current_as_c": None},
        {"AT_Name": "Spring 2022"},
        {"GAS_Name": "Fall 2022 (Semester)"},
        {"GAS_Name": None},
    ],
)
def test_records_left_out(spark, change):
    assert run(spark, FALL, [record("s1", "SS", **FIELDS) | change]).count() == 0


def test_rubric_flags_by_target_season(spark):
    rows = run(spark, SPRING, [record("s1", "FS"), record("s2", "FQ")]).collect()
    flags = {
        r.GAS_id: (r.missing_advising_rubric_career_v_2_c, r.missing_advising_rubric_wellness_v_2_c)
        for r in rows
    }
    assert flags["SS"] == (True, True)
    assert flags["WQ"] == (False, True)


def test_audit_and_unknown_calendars(spark):
    records = [record("s1", "SS"), record("s2", "SS"), record("s3", "SS", AT_Name="Spring")]
    audit = next_term_audit(run(spark, FALL, records)).collect()
    assert [(r.gas_name_to_create, r.n_students, r.n_records) for r in audit] == [
        ("Fall 2022 (Semester)", 2, 2)
    ]
    unknown = unknown_calendars(frame(spark, "student_term", records)).collect()
    assert [r.Contact_Id for r in unknown] == ["s3"]


ENROLMENT = {
    "account_id": "L1", "contact_id": "c1", "ate_id": "E1", "at_id": "old", "at_name": "Old",
    "ate_school_id": "A1", "ct_coach_ate_c": "C1", "major_c": "M", "ate_enrollment_status": "Full-time",
    "academic_calendar_ate_c": "Quarter", "current_ct_status_c": "Active",
    "current_ct_phase_c": "Post Secondary", "current_at_c": True,
}
ACADEMIC_TERMS = [
    {"at_id": "T1", "ay_id": "Y1", "at_name": "Summer", "season": "Summer",
     "academic_calendar_c": "Quarter", "at_start_date": date(2025, 7, 1),
     "at_end_date": date(2025, 9, 30)},
    {"at_id": "T2", "ay_id": "Y1", "at_name": "Fall", "season": "Fall",
     "academic_calendar_c": "Quarter", "at_start_date": date(2025, 10, 1)},
]


def enrolments(spark, rows, scholars=(), years=()):
    return next_term_enrolments(
        frame(spark, "term_enrolment", rows),
        frame(spark, "scholar", scholars),
        frame(spark, "academic_term", ACADEMIC_TERMS),
        frame(spark, "year_enrolment", years),
        TermSpec("Summer", date(2025, 7, 1)),
    )


def test_next_enrolment(spark):
    scholars = [{"account_id": "L1", "most_recent_num_cumulative_credits_pc": 30.0}]
    years = [{"aye_id": "Z1", "ay_id": "Y1", "account_id": "L1"}]
    rows = enrolments(spark, [ENROLMENT], scholars, years)
    assert len(rows.columns) == 23
    (row,) = rows.collect()
    assert (row.at_id, row.at_name_to_create, row.previous_academic_term_enrollment_c) == ("T1", "Summer", "E1")
    assert (row.academic_year_enrollment_c, row.student_academic_level) == ("Z1", "Undergraduate")
    assert (row.enrollment_date, row.exit_date) == (date(2025, 7, 1), date(2025, 9, 30))
    assert row.cumulative_credits_awarded_all_terms_c == 30.0


def test_missing_credits_and_year(spark):
    (row,) = enrolments(spark, [ENROLMENT]).collect()
    assert (row.academic_year_enrollment_c, row.cumulative_credits_awarded_all_terms_c) == (None, None)


@pytest.mark.parametrize(
    "status, phase, years, expected",
    [
        ("Active", "Post Secondary", None, ("M", "A1")),
        ("Inactive", "Post Secondary", 5.98, (None, "A1")),
        ("Inactive", "Post Secondary", 5.99, None),
        ("Active", "Alumni", 1.0, ("M", None)),
        # A missing status is not known to differ from active, so the value stays.
        (None, "Alumni", 1.0, ("M", None)),
        (None, "Post Secondary", 1.0, None),
        ("Active", "High School", 1.0, None),
    ],
)
def test_enrolment_phases(spark, status, phase, years, expected):
    change = {
        "current_ct_status_c": status,
        "current_ct_phase_c": phase,
        "years_since_high_school_graduation_ate_c": years,
    }
    rows = enrolments(spark, [ENROLMENT | change]).collect()
    assert [(r.major_c, r.school_c) for r in rows] == ([] if expected is None else [expected])
