from datetime import date

import pytest

from termweave.plans.degrees import (
    FOUR_YEAR_CREATE,
    FOUR_YEAR_UPDATE,
    TWO_YEAR_CREATE,
    TWO_YEAR_UPDATE,
    degree_records,
)
from termweave.sources.columns import STATUS_NAME
from tests.fixtures import SCHOOLS, SCORECARD, TERMS, degree, frame, record


def run(spark, spec, feed, records, partitions=None, schools=SCHOOLS):
    sources = [
        frame(spark, "nsc_feed", feed),
        frame(spark, "student_term", records),
        frame(spark, "school_account", schools),
        frame(spark, "scorecard", SCORECARD),
        frame(spark, "term", TERMS),
    ]
    if partitions:
        sources = [s.repartition(partitions) for s in sources]
    return degree_records(*sources, spec)


BACHELOR = ("BACHELOR OF ARTS", "SPANISH")


def test_four_year_update_row(spark):
    rows = run(spark, FOUR_YEAR_UPDATE, [degree("_S1_", 20221116, *BACHELOR)], [record("s1", "FS")])
    # Both accounts of the college hold a semester calendar, so the one degree is listed
    # twice per account and comes out once per account.
    rows = sorted(rows.collect(), key=lambda r: r.School__c)
    assert [r.School__c for r in rows] == ["A1", "A2"]
    assert rows[0].asDict() == {
        "Contact_Id": "s1",
        "full_name_c": "Name s1",
        "site_short": "Site",
        "for_prod_college_name": "River",
        "list_sfdc_major": "|".join(["Literature or Languages"] * 4),
        "AT_Name": "Fall 2022 (Semester) s1",
        "PAT_GAS_id": "FS",
        "nsc_graduation_date": date(2022, 11, 16),
        "nsc_college_name": "RIVER COLLEGE",
        "nsc_degree": "|".join(["BACHELOR OF ARTS"] * 4),
        "nsc_major": "|".join(["SPANISH"] * 4),
        "Id": "s1-FS",
        "School__c": "A1",
        "Major__c": "Literature or Languages",
        "Type_of_Degree_Earned__c": "4-year degree",
    }


@pytest.mark.parametrize(
    "change",
    [
        {"Requester_Return_Field": "s1"},  # lower case ids do not match
        {"Record_Found_Y_N": False},
        {"Record_Found_Y_N": None},
        {"Graduated_": None},
        {"_2_year___4_year": "2"},
        {"Degree_Title": "NURSING"},
        {"College_Code_Branch": "00000000-00"},
        {"Graduation_Date": 20220716},  # between terms
        {"Graduation_Date": None},
    ],
)
def test_feed_rows_that_update_nothing(spark, change):
    feed = [degree("S1", 20221116, *BACHELOR) | change]
    assert run(spark, FOUR_YEAR_UPDATE, feed, [record("s1", "FS")]).count() == 0


@pytest.mark.parametrize(
    "change",
    [
        {STATUS_NAME: "Alumni"},
        {"indicator_completed_ct_hs_program_c": False},
        {"AT_record_type_name": "High School Semester"},
        {"graduated_4_year_degree_c": True},
        {"graduated_4_year_degree_c": None},
    ],
)
def test_records_that_are_not_updated(spark, change):
    feed = [degree("S1", 20221116, *BACHELOR)]
    assert run(spark, FOUR_YEAR_UPDATE, feed, [record("s1", "FS") | change]).count() == 0


@pytest.mark.parametrize("status", ["Active: Post-Secondary", "Inactive: Post-Secondary"])
def test_quarter_record_of_a_semester_college_is_updated(spark, status):
    feed = [degree("S1", 20220501, None, None)]
    records = [record("s1", "SQ", **{STATUS_NAME: status})]
    rows = run(spark, FOUR_YEAR_UPDATE, feed, records).collect()
    assert {(r.PAT_GAS_id, r.nsc_degree, r.Major__c) for r in rows} == {("SQ", None, None)}


def test_malformed_graduation_date_raises(spark):
    with pytest.raises(Exception, match="DATETIME|Invalid|invalid"):
        run(spark, FOUR_YEAR_UPDATE, [degree("S1", 20221316, *BACHELOR)], [record("s1", "FS")]).collect()


def test_four_year_create_row(spark):
    feed = [
        degree("S1", 20221116, *BACHELOR),
        degree("S1", 20221110, "BS MULTIMEDIA", "MULTIMEDIA"),
        degree("S1", 20221110, *BACHELOR, College_State="TX"),
    ]
    rows = run(spark, FOUR_YEAR_CREATE, feed, [record("s1", "SS"), record("s1", "SQ")]).collect()
    # Only the account in the college's state gives a term, but every account of its IPEDS
    # id can be imported. The first date belongs to the earlier degree.
    assert sorted(r.School__c for r in rows) == ["A1", "A2"]
    river = next(r for r in rows if r.School__c == "A1").asDict()
    art, language = "Arts: Design, Performing, or Visual", "Literature or Languages"
    assert river == {
        "full_name_c": "Name s1",
        "site_short": "Site",
        "for_prod_college_name": "River",
        "list_sfdc_major": "|".join([art, art, language, language]),
        "GAS_Name": "Fall 2022 (Semester)",
        "nsc_graduation_date": "2022-11-10",
        "nsc_college_name": "RIVER COLLEGE",
        "nsc_degree": "BS MULTIMEDIA|BS MULTIMEDIA|BACHELOR OF ARTS|BACHELOR OF ARTS",
        "nsc_major": "MULTIMEDIA|MULTIMEDIA|SPANISH|SPANISH",
        "Student__c": "s1",
        "student_audit_status__c": "Active: Post-Secondary",
        "ct_status_at_c": "Active: Post-Secondary",
        "RecordTypeId": "01246000000RNnHAAW",
        "Global_Academic_Semester__c": "FS",
        "Academic_Year__c": "AY",
        "Name": "Fall 2022 (Semester) Name s1",
        "School__c": "A1",
        "Major__c": art,
        "Type_of_Degree_Earned__c": "4-year degree",
    }


def test_a_record_for_any_degree_keeps_others_from_being_created(spark):
    feed = [degree("S1", 20221116, *BACHELOR), degree("S1", 20220501, *BACHELOR)]
    assert run(spark, FOUR_YEAR_CREATE, feed, [record("s1", "FS")]).count() == 0


def test_two_year_update_takes_the_best_degree(spark):
    feed = [
        degree("S1", 20221116, "CERTIFICATE", "IGETC", _2_year___4_year="L"),
        degree("S1", 20221118, "ASSOCIATE OF ARTS", "SPANISH", _2_year___4_year="2"),
    ]
    rows = run(spark, TWO_YEAR_UPDATE, feed, [record("s1", "FS")], schools=SCHOOLS[:1]).collect()
    (row,) = rows
    # The lists hold the certificate, the row is the degree's.
    assert row.nsc_graduation_date == date(2022, 11, 18)
    assert row.list_sfdc_degrees == "2-year degree|Certificate"
    assert row.type_of_degree_earned_c == "2-year degree"
    assert row.list_sfdc_major == "Undeclared|Literature or Languages"
    assert row.Major__c == "Undeclared"


def test_two_year_records_with_a_degree(spark):
    feed = [degree("S1", 20221116, "CERTIFICATE", "IGETC")]
    held = record("s1", "FS", type_of_degree_earned_c="Certificate")
    assert run(spark, TWO_YEAR_UPDATE, feed, [held]).count() == 0
    # It still counts as the student's record, so nothing is created either.
    assert run(spark, TWO_YEAR_CREATE, feed, [held, record("s1", "SS")]).count() == 0
    # A held degree on another record does not open a new one by itself.
    held = record("s1", "SS", type_of_degree_earned_c="Certificate")
    assert run(spark, TWO_YEAR_CREATE, feed, [held]).count() == 0
    created = run(spark, TWO_YEAR_CREATE, feed, [held, record("s1", "SQ")]).collect()
    assert {(r.School__c, r.Type_of_Degree_Earned__c) for r in created} == {
        ("A1", "Certificate"),
        ("A2", "Certificate"),
    }


def test_two_year_create_takes_the_best_school_type(spark):
    schools = [dict(SCHOOLS[0]), dict(SCHOOLS[1])]
    schools[1].update(billing_state_code="CA", ipeds_id_c="78")
    feed = [degree("S1", 20221116, "CERTIFICATE", "IGETC")]
    sources = [
        frame(spark, "nsc_feed", feed),
        frame(spark, "student_term", [record("s1", "SS")]),
        frame(spark, "school_account", schools),
        frame(spark, "scorecard", SCORECARD + [{"INSTNM": "B", "UNITID": 78, "OPEID6": "123400"}]),
        frame(spark, "term", TERMS),
    ]
    rows = degree_records(*sources, TWO_YEAR_CREATE).collect()
    assert [r.School__c for r in rows] == ["A1"]
    assert rows[0].nsc_degree_earned == "CERTIFICATE|CERTIFICATE"


def many_degrees():
    titles = ["BACHELOR OF ARTS", "BS", None, "MBA"]
    majors = ["SPANISH", None, "MULTIMEDIA", "BIOLOGY", "ODD"]
    feed = [
        degree(f"S{i % 7}", 20221101 + i % 9, titles[i % 4], majors[i % 5]) for i in range(60)
    ]
    records = [record(f"s{i}", gas) for i in range(7) for gas in (("FS", "FQ") if i % 2 else ("SS",))]
    return feed, records


@pytest.mark.parametrize("spec", [FOUR_YEAR_UPDATE, FOUR_YEAR_CREATE])
def test_result_does_not_depend_on_partitioning(spark, spec):
    feed, records = many_degrees()
    once = run(spark, spec, feed, records, partitions=1)
    other = run(spark, spec, feed[::-1], records[::-1], partitions=6)
    assert once.count() > 0
    assert once.exceptAll(other).count() == 0
    assert other.exceptAll(once).count() == 0


def test_no_student_is_both_updated_and_created(spark):
    feed, records = many_degrees()
    updated = run(spark, FOUR_YEAR_UPDATE, feed, records).select("Contact_Id")
    created = run(spark, FOUR_YEAR_CREATE, feed, records).select("Student__c")
    assert updated.intersect(created).count() == 0
    assert updated.union(created).distinct().count() == 7


def test_one_student_with_most_rows(spark):
    """A third of all rows on one id gives the same rows per student as without the others."""
    feed, records = many_degrees()
    hot = [degree("HOT", 20221101 + i % 20, "BS", f"MAJOR {i % 11}") for i in range(400)]
    together = run(spark, FOUR_YEAR_UPDATE, feed + hot, records + [record("hot", "FS")], partitions=6)
    alone = run(spark, FOUR_YEAR_UPDATE, hot, [record("hot", "FS")], partitions=1)
    assert together.where("Contact_Id = 'hot'").exceptAll(alone).count() == 0
    assert alone.exceptAll(together).count() == 0
    # 220 distinct degrees, each with both accounts of the college, twice over.
    assert len(alone.first().nsc_major.split("|")) == 220 * 4
