"""Driver tables in the role of the CRM and feed sources.

Each source is one SELECT over whole driver tables, written in the SQL that Spark and DuckDB
share, so that both sides of a check start from the same rows. Values that the driver tables
lack (titles, majors, statuses) are picked from lists by a key of the row.
"""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from termweave.functions.codes import SCHOOL_TYPES
from termweave.operators.terms import TEST_TERM
from termweave.plans.activities import ActivitySpec
from termweave.sources.columns import STATUS_CODE, STATUS_NAME
from termweave.sources.schemas import RUBRIC_CARRIED, RUBRIC_RESET, SCHEMAS

DRIVER_TABLES = "region nation customer supplier part orders lineitem events documents".split()


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def pick(key: str, values: list[str | None]) -> str:
    """Text picked from a list by an integer key, round and round; ``~`` stands for NULL."""
    listed = _text("|".join("~" if v is None else v for v in values))
    picked = f"split_part({listed}, '|', CAST(({key}) % {len(values)} AS INT) + 1)"
    return f"nullif({picked}, '~')" if None in values else picked


def _day(c: str) -> str:
    return f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS BIGINT)"


def _half(key: str, n: int) -> str:
    return f"CAST(floor(({key}) / {n}) AS BIGINT)"


def _calendar_rows() -> list[tuple]:
    """Two semesters and four quarters a year, and a term that spans New Year."""
    shapes = [
        ("SS", "Semester", "Spring", 1, 6),
        ("SF", "Semester", "Fall", 7, 6),
        ("QW", "Quarter", "Winter", 1, 3),
        ("QS", "Quarter", "Spring", 4, 3),
        ("QU", "Quarter", "Summer", 7, 3),
        ("QF", "Quarter", "Fall", 10, 3),
        ("QI", "Quarter", "Intersession", 12, 3),
    ]
    rows = []
    for year in range(1995, 2002):
        for code, calendar, season, month, months in shapes:
            after = month + months - 1
            end = date(year + after // 12, after % 12 + 1, 1) - timedelta(days=1)
            short = f"{season} {year}"
            mark = "" if season == "Intersession" else f" ({calendar})"
            rows.append(
                (f"T{year}{code}", short + mark, short, f"Y{year}", season, calendar,
                 date(year, month, 1), end)
            )
    rows.append(
        ("T1998XX", TEST_TERM, "TEST", "Y1998", "Winter", "Quarter", date(1998, 1, 1), date(1998, 12, 31))
    )
    return rows


def _literal(value) -> str:
    return f"DATE '{value}'" if isinstance(value, date) else _text(value)


_TERM = (
    "SELECT * FROM (VALUES "
    + ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in _calendar_rows())
    + f") AS calendar({', '.join(SCHEMAS['term'].names)})"
)

_TITLES = [
    None, "BACHELOR OF ARTS", "BS BIOLOGY", "MBA", "ABCD", "ASSOCIATE OF ARTS", "CERTIFICATE",
    "UNDERGRADUATE CERTIFICATE", "POST-BACCALAUREATE CERTIFICATE", "AA ", "AA",
    "CERTIFICATE OF ACHIEVEMENT", "AS SCIENCE",
]
_MAJORS = [
    None, "ASSOCIATE OF ARTS", "SPANISH", "NURSING", "PRE-NURSING", "BIOLOGY", "MULTIMEDIA",
    "MULTIMEDIA DESIGN & DEVELOPMENT", "COMPUTER SCIENCE", "BIOTECHNOLOGY", "ECONOMICS",
    "COMMUNICATION", "COMMUNICATION STUDIES", "GENERAL", "GENERAL STUDIES", "IGETC",
    "AMERICAN HISTORY", "BASKETRY", "CRIMINAL JUSTICE", "MECHANICAL ENGINEERING",
    "APPLIED MATH",
]
_STATUSES = ["Active: Post-Secondary", "Inactive: Post-Secondary", "Active: Post-Secondary",
             "Alumni"]
_LAST_NAMES = ["Smith III", "Lee Jr.", "LeeIV", "O'Neil", "José", "Smith-Jones", "Núñez V",
               "Müller", "d'Arc IX", "Ng", "Jrx", "Val VIII"]
_FIRST_NAMES = ["Ana M.", "A'kira", "José", "Zoë é.", "J.R.", "Li", "Mary-Ann", "Bob Q. T."]
_MIDDLE_NAMES = [None, "", "d4vid!", "ángel", "7", "Lee", "o'b"]
_SITES = ["East Palo Alto", "Oakland", "San Francisco", "Denver", "New Orleans"]
_ACTIVITY = ActivitySpec()

_RUBRIC = ", ".join(
    f"'{name[:4]}' || CAST(custkey % {3 + i} AS STRING) AS {name}"
    for i, name in enumerate(RUBRIC_CARRIED + RUBRIC_RESET)
)

STANDINS = {
    "term": _TERM,
    "academic_term": """
        SELECT GAS_id AS at_id, academic_year_c AS ay_id, GAS_Name AS at_name,
            term_c AS season, academic_calendar_category_c AS academic_calendar_c,
            GAS_start_date AS at_start_date, GAS_end_date AS at_end_date
        FROM {term}
    """,
    "user": """
        SELECT 'U' || CAST(n_nationkey AS STRING) AS user_id, n_name AS user_name,
            n_regionkey <> 0 AS is_active
        FROM {nation}
    """,
    # Two accounts per name, three per IPEDS id, in different states and calendars.
    "school_account": f"""
        SELECT 'A' || CAST(s_suppkey AS STRING) AS account_id,
            'College ' || CAST({_half('s_suppkey', 2)} AS STRING) AS account_name,
            {pick('s_suppkey', SCHOOL_TYPES + [None])} AS predominant_degree_awarded_c,
            {pick('s_suppkey', ['Semester System', 'Quarter System', 'Trimester', 'Semester', None])}
                AS academic_calendar_value_c,
            'State ' || CAST(s_suppkey % 4 AS STRING) AS billing_state,
            'S' || CAST(s_suppkey % 4 AS STRING) AS billing_state_code,
            CASE WHEN s_suppkey % 10 <> 7 THEN CAST({_half('s_suppkey', 3)} AS STRING) END
                AS ipeds_id_c,
            s_acctbal < 0 AS school_permanently_closed_c
        FROM {{supplier}}
    """,
    # Two IPEDS ids per branch code.
    "scorecard": f"""
        SELECT DISTINCT 'Scorecard ' || CAST({_half('s_suppkey', 3)} AS STRING) AS INSTNM,
            {_half('s_suppkey', 3)} AS UNITID,
            CAST({_half('s_suppkey', 6)} AS STRING) AS OPEID6
        FROM {{supplier}}
    """,
    # A degree and an enrolment span per order line.
    "nsc_feed": f"""
        SELECT CASE WHEN l_linenumber = 7 THEN 'c_' ELSE 'C_' END || CAST(o_custkey AS STRING)
                AS Requester_Return_Field,
            'First' || CAST(o_custkey AS STRING) AS First_Name,
            'Last' || CAST(o_custkey AS STRING) AS Last_Name,
            l_discount < 0.095 AS Record_Found_Y_N,
            CAST(20220701 AS BIGINT) AS Search_Date,
            lpad(CAST({_half('l_suppkey', 6)} AS STRING), 8, '0') || '-0'
                || CAST(l_linenumber AS STRING) AS College_Code_Branch,
            'College ' || CAST({_half('l_suppkey', 2)} AS STRING) AS College_Name,
            'S' || CAST(l_suppkey % 4 AS STRING) AS College_State,
            {pick('l_linenumber', ['4', '2', '4', 'L'])} AS _2_year___4_year,
            {pick('l_suppkey', ['Public', 'Private'])} AS Public___Private,
            {_day('o_orderdate')} AS Enrollment_Begin,
            {_day('l_shipdate')} AS Enrollment_End,
            {pick('l_linenumber', ['F', 'Q', 'H', 'L', 'A', ' ', 'W'])} AS Enrollment_Status,
            {pick('l_partkey', list('FSJRCNBAMDPLGTX') + [None])} AS Class_Level,
            upper(p_name) AS Enrollment_Major_1,
            p_type AS Enrollment_Major_2,
            l_returnflag <> 'N' AS Graduated_,
            CASE WHEN l_returnflag <> 'N' THEN {_day('l_shipdate')} END AS Graduation_Date,
            {pick('p_size', _TITLES)} AS Degree_Title,
            {pick('l_partkey', _MAJORS)} AS Degree_Major_1,
            p_brand AS Degree_Major_2, p_type AS Degree_Major_3,
            CAST(NULL AS STRING) AS Degree_Major_4,
            l_linenumber AS College_Sequence
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
            JOIN {{part}} ON l_partkey = p_partkey
    """,
    # A record per student and term of a filled order.
    "student_term": f"""
        SELECT 'c' || CAST(custkey AS STRING) AS Contact_Id,
            'R' || CAST(custkey AS STRING) || '-' || GAS_id AS AT_Id,
            GAS_Name || ' Student ' || CAST(custkey AS STRING) AS AT_Name,
            'Student ' || CAST(custkey AS STRING) AS full_name_c,
            {pick('custkey', _SITES)} AS site_short,
            {pick('custkey', _STATUSES)} AS {STATUS_NAME},
            {pick(_half('custkey', 2), ['15A', '16A', '17A', '18A', '15A'])} AS {STATUS_CODE},
            CAST(1990 + custkey % 10 AS STRING) AS high_school_graduating_class_c,
            'A' || CAST(school AS STRING) AS school_account_18_id_c,
            'U' || CAST(custkey % 30 AS STRING) AS cc_advisor_c,
            {pick('custkey + school', ['Full-time', 'Not Enrolled', 'Part-time', None, 'On Leave'])}
                AS AT_Enrollment_Status_c,
            'School ' || CAST(school AS STRING) AS AT_School_Name,
            CASE custkey % 3 WHEN 0 THEN 5.98e0 WHEN 1 THEN 5.99e0 END
                AS indicator_years_since_hs_graduation_c,
            CAST(custkey % 8 + school % 2 AS DOUBLE) AS years_since_hs_grad_c,
            {pick('custkey + school', [None, None, None, '2-year degree'])}
                AS type_of_degree_earned_c,
            {pick('custkey', [None, 'AY 1999'])} AS academic_year_4_year_degree_earned_c,
            GAS_start_date, GAS_end_date, GAS_Name, GAS_Name_short, term_c,
            academic_year_c AS AY_Name, GAS_id AS global_academic_semester_c,
            custkey % 11 <> 0 AS indicator_completed_ct_hs_program_c,
            custkey % 13 = 0 AS graduated_4_year_degree_c,
            custkey % 5 <> 0 AS current_as_c,
            {pick('custkey', ['High School Semester'] + ['College/University Semester'] * 16)}
                AS AT_record_type_name,
            {pick('school', _MAJORS)} AS major_c, {pick('school', [None, 'Other'])} AS major_other_c,
            {pick('school', [None, 'Second'])} AS second_major_c,
            {pick('school', ['Minor', None])} AS minor_c,
            'School ' || CAST(school AS STRING) AS school_c,
            'U' || CAST(custkey % 30 AS STRING) AS cc_advisor_at_user_id_c,
            {pick('school', [None, 'Full-time', 'Part-time'])} AS enrollment_status_c,
            {pick('school', ['Part-time', None])} AS persistence_at_prev_enrollment_status_c,
            CAST(school % 120 AS DOUBLE) AS cumulative_credits_awarded_most_recent_c,
            {_RUBRIC}
        FROM (
            SELECT o_custkey AS custkey, GAS_id, min(l_suppkey) AS school
            FROM {{orders}} JOIN {{lineitem}} ON o_orderkey = l_orderkey
                JOIN {{term}} ON year(o_orderdate) = year(GAS_start_date)
                    AND CAST(o_orderdate AS DATE) BETWEEN GAS_start_date AND GAS_end_date
            WHERE o_orderstatus = 'F' AND GAS_Name <> '{TEST_TERM}'
            GROUP BY o_custkey, GAS_id
        ) AS attended JOIN {{term}} USING (GAS_id)
    """,
    "term_enrolment": f"""
        SELECT 'L' || CAST(o_custkey AS STRING) AS account_id,
            'c' || CAST(o_custkey AS STRING) AS contact_id,
            'U' || CAST(o_custkey % 30 AS STRING) AS owner_id,
            'E' || CAST(o_orderkey AS STRING) AS ate_id,
            'T' || CAST(year(o_orderdate) AS STRING) AS at_id,
            'Term of ' || CAST(year(o_orderdate) AS STRING) AS at_name,
            'School ' || CAST(o_custkey % 50 AS STRING) AS ate_school_id,
            'Coach ' || CAST(o_custkey % 9 AS STRING) AS ct_coach_ate_c,
            'Case ' || CAST(o_custkey AS STRING) AS ct_case_c,
            {pick('o_orderkey', [None, 'Yes'])} AS concurrent_school_enrolled_c,
            o_orderpriority AS ct_status_ate_c,
            {pick('o_orderkey', ['Full-time', 'Part-time', None])} AS ate_enrollment_status,
            'Category' AS major_category_c,
            {pick('o_orderkey', _MAJORS)} AS major_c,
            {pick('o_orderkey', [None, 'Category 2'])} AS second_major_category_c,
            {pick('o_orderkey', [None, 'Second'])} AS second_major_c,
            {pick('o_orderkey', ['Minor', None])} AS minor_c,
            {pick('o_orderkey', ['Semester', 'Quarter', 'Semester', 'None'])}
                AS academic_calendar_ate_c,
            {pick('o_custkey', ['Active', 'Inactive', None, 'Active'])} AS current_ct_status_c,
            {pick('o_orderkey', ['Post Secondary', 'Alumni', 'Post Secondary', 'High School'])}
                AS current_ct_phase_c,
            CASE o_custkey % 3 WHEN 0 THEN 5.98e0 WHEN 1 THEN 5.99e0 END
                AS years_since_high_school_graduation_ate_c,
            o_orderstatus <> 'P' AS current_at_c
        FROM {{orders}}
    """,
    "scholar": """
        SELECT 'L' || CAST(c_custkey AS STRING) AS account_id,
            CASE WHEN c_acctbal > 0 THEN c_acctbal END AS most_recent_num_cumulative_credits_pc
        FROM {customer}
        WHERE c_mktsegment <> 'FURNITURE'
    """,
    "year_enrolment": """
        SELECT DISTINCT 'Z' || CAST(o_custkey AS STRING) || '-'
                || CAST(year(o_orderdate) AS STRING) AS aye_id,
            'Y' || CAST(year(o_orderdate) AS STRING) AS ay_id,
            'L' || CAST(o_custkey AS STRING) AS account_id
        FROM {orders}
    """,
    "contact": f"""
        SELECT 'c' || CAST(c_custkey AS STRING) AS contact_id,
            'Student ' || CAST(c_custkey AS STRING) AS full_name_c,
            {pick('c_custkey', _SITES)} AS site_short,
            r_name AS region_short,
            {pick('c_custkey', _FIRST_NAMES)} AS first_name,
            {pick('c_custkey', _MIDDLE_NAMES)} AS middle_name,
            {pick('c_custkey', _LAST_NAMES)} AS last_name,
            CASE WHEN c_acctbal > 0 THEN DATE '1980-01-01' + CAST(c_custkey % 9000 AS INT) END
                AS birthdate,
            CAST(1998 + c_custkey % 10 AS INT) AS high_school_graduating_class_c,
            c_custkey % 11 <> 0 AS indicator_completed_ct_hs_program_c
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
            JOIN {{region}} ON n_regionkey = r_regionkey
    """,
    "engagement": f"""
        SELECT 'G' || CAST(event_id AS STRING) AS id,
            'c' || CAST(user_id AS STRING) AS student_c,
            'RG' || CAST(user_id % 6 AS STRING) AS organization_c,
            CASE WHEN event_type IN ('purchase', 'signup') THEN '{_ACTIVITY.engagement_type}'
                ELSE 'other' END AS record_type_id,
            CASE WHEN value < 50 THEN '{_ACTIVITY.academic_year}' ELSE 'other' END
                AS global_academic_year_c,
            {pick('event_id', [_ACTIVITY.participation, 'Interviewed', None])}
                AS program_participation_status_c
        FROM {{events}}
    """,
    # Visits of a region by nation; no visit belongs to the sixth region.
    "visit": """
        SELECT 'RG' || CAST(n_regionkey AS STRING) AS region_id,
            'c' || CAST(n_nationkey AS STRING) AS contact_id, n_name AS Account,
            'A' || CAST(n_nationkey AS STRING) AS Account_ID, 'Company Visit' AS type_of_event,
            DATE '2023-02-01' + CAST(n_nationkey AS INT) AS DATE
        FROM {nation}
    """,
    "schedule": """
        SELECT CAST(NULL AS STRING) AS region_id, 'c' || CAST(o_custkey AS STRING) AS contact_id,
            'Company ' || CAST(o_orderkey % 40 AS STRING) AS Account,
            'A' || CAST(o_orderkey % 40 AS STRING) AS Account_ID,
            o_orderpriority AS type_of_event, CAST(o_orderdate AS DATE) AS DATE
        FROM {orders}
    """,
    "application_template": f"""
        SELECT 'Student ' || CAST(o_custkey AS STRING) AS Full_Name,
            {pick('o_custkey', _SITES)} AS Site,
            CASE WHEN o_orderkey % 9 <> 0 THEN 'College '
                || CAST({_half('o_custkey', 30)} + o_orderkey % 3 AS STRING) END
                AS College_University,
            'c' || CAST(o_custkey AS STRING) AS _18_Digit_ID,
            {pick('o_orderkey', ['Applied', None, 'Prospect', 'Applied'])} AS Application_Status,
            {pick('o_orderkey', [None, 'Accepted'])} AS Admission_Status,
            {pick('o_orderkey', ['Yes', 'No'])} AS Requested_application_fee_waiver,
            {pick('o_orderkey', ['Yes', None])} AS Application_fee_waiver_granted_,
            {pick('o_orderkey', ['No', 'Yes'])} AS Requested_Application_Fee_Payment_,
            CAST(CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 0 ELSE 1 END
                AS INT) AS EditTracker,
            CAST(NULL AS STRING) AS User, CAST(o_orderkey AS INT) AS row
        FROM {{orders}}
    """,
    "application_fact": f"""
        SELECT 'P' || CAST(o_orderkey AS STRING) AS college_app_id,
            'c' || CAST(o_custkey AS STRING) AS contact_id,
            'College ' || CAST({_half('o_custkey', 30)} + o_orderkey % 3 AS STRING) AS college_name
        FROM {{orders}}
        WHERE o_orderstatus = 'F'
    """,
    "admission_template": f"""
        SELECT 'Student ' || CAST(o_custkey AS STRING) AS Full_Name,
            {pick('o_custkey', _SITES)} AS Site,
            'College ' || CAST({_half('o_custkey', 30)} + o_orderkey % 3 AS STRING)
                AS College_University__Account_Name,
            'P' || CAST(o_orderkey AS STRING) AS College_Application__ID,
            {pick('o_orderkey', ['Applied', None, 'Prospect'])} AS Application_Status,
            {pick('o_orderkey', ['Accepted', None])} AS Admission_Status,
            {pick('o_orderkey', ['Paid', None])} AS Enrollment_Deposit,
            {pick('o_orderkey', ['Submitted', None])} AS Housing_Application,
            {pick('o_orderkey', ['Verified', None])} AS Financial_Aid_Verification_Status,
            {pick('o_orderkey', ['Received', None])} AS Award_Letter,
            CAST(CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 0 ELSE 1 END
                AS INT) AS EditTracker,
            CAST(o_orderkey AS INT) AS row
        FROM {{orders}}
    """,
    "aid_template": f"""
        SELECT 'Student ' || CAST(c_custkey AS STRING) AS Full_Name,
            {pick('c_custkey', ['12th', '11th'])} AS grade,
            {pick('c_custkey', _SITES)} AS Site,
            'c' || CAST(c_custkey AS STRING) AS _18_Digit_ID,
            {pick('c_custkey', ['Submitted', None])} AS FA_Req__FAFSA_Alternative_Financial_Aid,
            c_mktsegment AS FA_Req__EFC_Source,
            c_acctbal AS FA_Req__Exp_Financial_Contribution__EFC_,
            c_acctbal * 2 AS FA_Req__Annual_Adjusted_Gross_Income,
            CAST(CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 1 END AS INT)
                AS EditTracker,
            CAST(c_custkey AS INT) AS row
        FROM {{customer}}
    """,
    "edit_log": f"""
        SELECT {pick('user_id', ['READ', 'Applications', 'Aid', 'Admissions'])} AS sheet,
            CAST(user_id AS INT) AS row,
            event_type AS column,
            {pick('event_id', [None, 'same', 'old', ''])} AS old_value,
            {pick('event_id + CAST(floor(value) AS INT)', ['same', 'new', None, '', 'old'])} AS new_value,
            'u' || CAST(event_id % 10 AS STRING) AS user,
            ts, event_id AS seq
        FROM {{events}}
    """,
}

# Sources that share the schema of another one.
_SCHEMA_OF = {"schedule": "visit"}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in source with the types of its schema."""
    if name in DRIVER_TABLES:
        return driver_table(spark, sf_dir, name)
    text = STANDINS[name]
    needed = {n: source(spark, sf_dir, n) for n in _references(text)}
    rows = spark.sql(text, **needed)
    schema = SCHEMAS[_SCHEMA_OF.get(name, name)]
    return rows.selectExpr(
        [f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema]
    )


def _references(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def with_sources(names: str, query: str) -> str:
    """SQL with the named stand-ins, and those they read, as leading CTEs."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in DRIVER_TABLES or name in order:
            return
        for needed in _references(STANDINS[name]):
            add(needed)
        order.append(name)

    for name in names.split():
        add(name)
    ctes = [f"{n} AS ({re.sub(r'{(\w+)}', r'\1', STANDINS[n]).strip()})" for n in order]
    query = query.strip()
    if query.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + query[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + query
