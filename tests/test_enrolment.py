import pytest

from termweave.plans.enrolment import enrolment_discrepancies, feed_to_term_short, span_term_counts
from termweave.sources.columns import STATUS_NAME
from tests.fixtures import SCHOOLS, SCORECARD, TERMS, frame, record

SPAN = {
    "Requester_Return_Field": "S_1",
    "Record_Found_Y_N": True,
    "College_Code_Branch": "00123400-01",
    "College_Name": "RIVER COLLEGE",
    "Enrollment_Begin": 20220822,
    "Enrollment_End": 20221216,
    "Enrollment_Status": "H",
    "Class_Level": "A",
}
RECORD = record("s1", "FS", AT_Enrollment_Status_c="Not Enrolled", school_account_18_id_c="A1",
                cc_advisor_c="U1", years_since_hs_grad_c=2.0)
USERS = [{"user_id": "U1", "user_name": "Ada", "is_active": True}]
OTHER_COLLEGE = dict(SCHOOLS[0], account_id="B1", ipeds_id_c="88")


def run(spark, feed, records, same_college=True):
    return enrolment_discrepancies(
        frame(spark, "nsc_feed", feed),
        frame(spark, "student_term", records),
        frame(spark, "school_account", SCHOOLS + [OTHER_COLLEGE]),
        frame(spark, "scorecard", SCORECARD),
        frame(spark, "term", TERMS),
        frame(spark, "user", USERS),
        same_college,
    )


def test_discrepancy_row(spark):
    rows = run(spark, [SPAN, SPAN], [RECORD])
    assert len(rows.columns) == 38
    (row,) = rows.collect()
    assert (row.AT_Id, row.nsc_enrollment_status_ft_pt, row.Class) == ("s1-FS", "Part-time", "Associate's")
    assert (row.cc_advisor, row.active_user, row.nsc_Year) == ("Ada", True, 2022)
    assert row.academic_calendar_category_c == "Semester"
    assert run(spark, [SPAN], [RECORD], same_college=False).count() == 0


def test_one_row_per_state_of_the_student(spark):
    other = record("s1", "SS", years_since_hs_grad_c=3.0, AT_Enrollment_Status_c="Full-time")
    assert run(spark, [SPAN], [RECORD, other]).count() == 2
    same = record("s1", "SS", years_since_hs_grad_c=2.0, AT_Enrollment_Status_c="Full-time")
    assert run(spark, [SPAN], [RECORD, same]).count() == 1


def test_other_college(spark):
    elsewhere = RECORD | {"school_account_18_id_c": "B1"}
    rows = run(spark, [SPAN], [elsewhere], same_college=False)
    assert rows.columns[0] == "indicator_enrollment_discr"
    assert [r.indicator_enrollment_discr for r in rows.collect()] == [1]
    assert run(spark, [SPAN], [elsewhere]).count() == 0


@pytest.mark.parametrize(
    "change",
    [
        {"Enrollment_Status": " "},
        {"Enrollment_Status": "W"},
        {"Record_Found_Y_N": None},
        {"Requester_Return_Field": "UNKNOWN"},
        {"Enrollment_End": 20240101},
    ],
)
def test_feed_rows_left_out(spark, change):
    assert run(spark, [SPAN | change], [RECORD]).count() == 0


@pytest.mark.parametrize(
    "change",
    [
        {"AT_Enrollment_Status_c": "Full-time"},
        {"AT_Enrollment_Status_c": None},
        {"school_account_18_id_c": "A3"},
        {"school_account_18_id_c": None},
        {"AT_record_type_name": "High School Semester"},
    ],
)
def test_records_left_out(spark, change):
    for same_college in (True, False):
        assert run(spark, [SPAN], [RECORD | change], same_college).count() == 0


def test_students_who_left_the_programme_count_here(spark):
    gone = RECORD | {"indicator_completed_ct_hs_program_c": False, STATUS_NAME: None}
    assert run(spark, [SPAN], [gone]).count() == 1


def test_term_counts_and_short_names(spark):
    feed = frame(spark, "nsc_feed", [SPAN, SPAN | {"Requester_Return_Field": "UNKNOWN"}])
    terms = frame(spark, "term", TERMS)
    counts = {
        (r.GAS_Name_short, r.start_rank, r.end_rank): r.num_terms
        for r in span_term_counts(feed, terms).collect()
    }
    # The winter term that ends next year is a candidate as well; the test row, too.
    assert counts[("Fall 2022", 1, 1)] == 1
    assert counts[("Winter 2023", 3, 2)] == 1
    rows = feed_to_term_short(
        feed, frame(spark, "student_term", [RECORD]), frame(spark, "scorecard", SCORECARD), terms
    ).collect()
    assert {(r.contact_id_nsc, r.GAS_Name_short, r.sfdc_years_since_hs_grad) for r in rows} == {
        ("S1", "Fall 2022", 2.0),
        ("UNKNOWN", "Fall 2022", None),
    }
