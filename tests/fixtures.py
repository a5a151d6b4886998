"""Small invented sources. Columns a test does not name are NULL."""

from datetime import date

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema

from termweave.sources.columns import STATUS_CODE, STATUS_NAME
from termweave.sources.schemas import SCHEMAS


def frame(spark, source, rows):
    """A source of local rows; going through Arrow gives it a size that Catalyst knows."""
    schema = SCHEMAS[source]
    table = pa.Table.from_pylist(
        [{n: r.get(n) for n in schema.names} for r in rows], schema=to_arrow_schema(schema)
    )
    return spark.createDataFrame(table, schema)


def term(gas_id, name, calendar, start, end, season="Fall"):
    return {
        "GAS_id": gas_id,
        "GAS_Name": name,
        "GAS_Name_short": name.split(" (")[0],
        "academic_year_c": "AY",
        "term_c": season,
        "academic_calendar_category_c": calendar,
        "GAS_start_date": start,
        "GAS_end_date": end,
    }


TERMS = [
    term("FS", "Fall 2022 (Semester)", "Semester", date(2022, 8, 1), date(2022, 12, 31)),
    term("FQ", "Fall 2022 (Quarter)", "Quarter", date(2022, 9, 15), date(2022, 12, 31)),
    term("SS", "Spring 2022 (Semester)", "Semester", date(2022, 1, 1), date(2022, 6, 30), "Spring"),
    term("SQ", "Spring 2022 (Quarter)", "Quarter", date(2022, 4, 1), date(2022, 6, 30), "Spring"),
    term("WQ", "Winter 2022 (Quarter)", "Quarter", date(2022, 1, 1), date(2022, 3, 31), "Winter"),
    term("NY", "Winter 2023", "Quarter", date(2022, 12, 1), date(2023, 2, 28), "Winter"),
    term("XX", "TEST ONLY  WINTER PREV AT", "Quarter", date(2022, 1, 1), date(2022, 12, 31)),
]


def degree(contact, day, title, major, **more):
    return {
        "Requester_Return_Field": contact,
        "Record_Found_Y_N": True,
        "Graduated_": True,
        "College_Code_Branch": "00123400-01",
        "College_Name": "RIVER COLLEGE",
        "College_State": "CA",
        "_2_year___4_year": "4",
        "Graduation_Date": day,
        "Degree_Title": title,
        "Degree_Major_1": major,
        **more,
    }


def record(contact, gas_id, **more):
    name = next(t["GAS_Name"] for t in TERMS if t["GAS_id"] == gas_id)
    return {
        "Contact_Id": contact,
        "AT_Id": f"{contact}-{gas_id}",
        "AT_Name": f"{name} {contact}",
        "full_name_c": f"Name {contact}",
        "site_short": "Site",
        STATUS_NAME: "Active: Post-Secondary",
        STATUS_CODE: "15A",
        "GAS_Name": name,
        "global_academic_semester_c": gas_id,
        "indicator_completed_ct_hs_program_c": True,
        "graduated_4_year_degree_c": False,
        "current_as_c": True,
        "AT_record_type_name": "College/University Semester",
        **more,
    }


SCHOOLS = [
    {"account_id": "A1", "account_name": "River", "ipeds_id_c": "77",
     "billing_state_code": "CA", "academic_calendar_value_c": "Semester system",
     "predominant_degree_awarded_c": "Predominantly bachelor's-degree granting"},
    {"account_id": "A2", "account_name": "River East", "ipeds_id_c": "77",
     "billing_state_code": "NY", "academic_calendar_value_c": "Trimester",
     "predominant_degree_awarded_c": "Predominantly associate's-degree granting"},
    {"account_id": "A3", "account_name": "No id", "ipeds_id_c": None,
     "billing_state_code": "CA", "academic_calendar_value_c": "Quarter"},
]

SCORECARD = [{"INSTNM": "River College", "UNITID": 77, "OPEID6": "123400"}]
