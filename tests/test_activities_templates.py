from datetime import date

import pytest

from termweave.plans.activities import ActivitySpec, readiness_activities
from termweave.plans.templates import admission_edits, aid_edits, new_applications
from tests.fixtures import frame

SPEC = ActivitySpec()
ENGAGEMENT = {
    "id": "G1", "student_c": "c1", "organization_c": "R1", "record_type_id": SPEC.engagement_type,
    "global_academic_year_c": SPEC.academic_year,
    "program_participation_status_c": SPEC.participation,
}
CONTACTS = [
    {"contact_id": "c1", "full_name_c": "Ann", "site_short": "Oakland", "region_short": "Bay"},
    {"contact_id": "c2", "full_name_c": "Bo", "site_short": "Denver", "region_short": "CO"},
]
VISITS = [
    {"region_id": "R1", "contact_id": "c1", "Account": "V1", "Account_ID": "A1", "DATE": date(2023, 2, 1)},
    {"region_id": "R1", "contact_id": "c1", "Account": "V2", "Account_ID": "A2", "DATE": date(2023, 2, 2)},
    {"region_id": "R9", "contact_id": "c2", "Account": "V3", "Account_ID": "A3", "DATE": date(2023, 2, 3)},
]


def activities(spark, engagements, by):
    rows = readiness_activities(
        frame(spark, "engagement", engagements),
        frame(spark, "contact", CONTACTS),
        frame(spark, "visit", VISITS),
        by=by,
    )
    assert len(rows.columns) == 11
    return sorted((r.student_c, r.Site, str(r.Account), r.recordtypeid) for r in rows.collect())


def test_region_visits(spark):
    other = ENGAGEMENT | {"id": "G2", "student_c": "c9", "organization_c": "R2"}
    left_out = [
        ENGAGEMENT | {"record_type_id": "x"},
        ENGAGEMENT | {"program_participation_status_c": None},
        ENGAGEMENT | {"global_academic_year_c": "x"},
    ]
    assert activities(spark, [ENGAGEMENT, other, *left_out], "region") == [
        ("c1", "Oakland", "V1", SPEC.activity_type),
        ("c1", "Oakland", "V2", SPEC.activity_type),
        ("c9", None, "None", SPEC.activity_type),
    ]


def test_student_schedule(spark):
    elsewhere = ENGAGEMENT | {"student_c": "c2"}
    unknown = ENGAGEMENT | {"student_c": "c9"}
    assert activities(spark, [ENGAGEMENT, elsewhere, unknown], "student") == [
        ("c1", "Oakland", "V1", SPEC.activity_type),
        ("c1", "Oakland", "V2", SPEC.activity_type),
    ]
    with pytest.raises(ValueError):
        activities(spark, [ENGAGEMENT], "site")


ACCOUNTS = [
    {"account_id": "A1", "account_name": "River"},
    {"account_id": "A2", "account_name": "River"},
]
APPLICATION = {
    "Full_Name": "Ann", "College_University": "River", "_18_Digit_ID": "c1",
    "Application_Status": "Applied", "EditTracker": 1,
}


@pytest.mark.parametrize(
    "change, accounts",
    [
        ({}, ["A1", "A2"]),
        ({"College_University": "Lake"}, [None]),
        ({"EditTracker": 0}, []),
        ({"EditTracker": None}, []),
        ({"College_University": None}, []),
        ({"Application_Status": None}, []),
        ({"_18_Digit_ID": "c2"}, []),
        ({"_18_Digit_ID": None}, ["A1", "A2"]),
    ],
)
def test_new_applications(spark, change, accounts):
    known = [{"college_app_id": "P1", "contact_id": "c2", "college_name": "River"}]
    rows = new_applications(
        frame(spark, "application_template", [APPLICATION | change]),
        frame(spark, "school_account", ACCOUNTS),
        frame(spark, "application_fact", known),
    )
    assert len(rows.columns) == 10
    assert sorted((r.college_university__c for r in rows.collect()), key=str) == accounts


def test_admission_edits_repeat_for_a_shared_account_name(spark):
    edit = {"College_University__Account_Name": "River", "College_Application__ID": "P1",
            "Admission_Status": "Accepted", "EditTracker": 1}
    rows = admission_edits(
        frame(spark, "admission_template", [edit, edit | {"Admission_Status": None}]),
        frame(spark, "school_account", ACCOUNTS),
    )
    assert len(rows.columns) == 10
    assert [r.id for r in rows.collect()] == ["P1", "P1"]


def test_aid_edits(spark):
    edits = [{"_18_Digit_ID": "c1", "EditTracker": 1}, {"_18_Digit_ID": "c2", "EditTracker": None}]
    rows = aid_edits(frame(spark, "aid_template", edits))
    assert len(rows.columns) == 8
    assert [r.id for r in rows.collect()] == ["c1"]
