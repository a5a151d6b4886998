"""Checking SQL of the products, stated without the shortcuts the Spark plans take."""

from __future__ import annotations

from catalogue.operator_queries import _MAJOR_LABELS
from catalogue.standins import with_sources
from termweave.sources.columns import STATUS_CODE, STATUS_NAME
from termweave.sources.schemas import RUBRIC_CARRIED

_DEGREE_SOURCES = "nsc_feed student_term school_account scorecard term"

_CROSSWALK = """
    accounts AS (
        SELECT *, CASE WHEN split_part(academic_calendar_value_c, ' ', 1) = 'Trimester'
                THEN 'Semester' ELSE split_part(academic_calendar_value_c, ' ', 1) END AS calendar,
            CASE WHEN predominant_degree_awarded_c LIKE '%bachelor%' THEN 1
                WHEN predominant_degree_awarded_c LIKE '%associate%' THEN 2 ELSE 3 END AS kind_rank
        FROM school_account
    ),
    crosswalk AS (
        SELECT *, CAST(UNITID AS VARCHAR) AS unit
        FROM accounts LEFT JOIN scorecard ON ipeds_id_c = CAST(UNITID AS VARCHAR)
    )
"""


def _mapped(four_year: bool) -> str:
    if four_year:
        titles = "(Degree_Title IS NULL OR regexp_matches(Degree_Title, 'BACHELOR|BS|BA|AB'))"
        levels = "_2_year___4_year = '4'"
    else:
        titles = """regexp_matches(Degree_Title, 'ASSOCIATE|CERTIF|AA |AS |CA ')
            AND Degree_Title NOT LIKE '%POST-BACCALAUREATE%'
            AND Degree_Title NOT LIKE '%GRADUATE%'"""
        levels = "_2_year___4_year IN ('4', '2', 'L')"
    return f"""
    grads AS (
        SELECT replace(Requester_Return_Field, '_', '') AS cid, College_Name, College_State,
            ltrim(split_part(College_Code_Branch, '-', 1), '0') AS code,
            CAST(strptime(CAST(Graduation_Date AS VARCHAR), '%Y%m%d') AS DATE) AS grad_day,
            Degree_Title AS title, Degree_Major_1 AS major
        FROM nsc_feed
        WHERE Record_Found_Y_N AND Graduated_ AND {levels} AND {titles}
    ),
    feed AS (
        SELECT grads.*, account_id, account_name, calendar, kind_rank, billing_state_code, unit
        FROM grads LEFT JOIN crosswalk ON code = OPEID6
    ),
    near AS (
        SELECT DISTINCT cid, grad_day, GAS_id, GAS_Name, academic_year_c,
            academic_calendar_category_c AS term_calendar, dense_rank() OVER (
                PARTITION BY cid, grad_day ORDER BY abs(date_diff('day', grad_day, GAS_start_date)))
                AS nearness
        FROM (SELECT DISTINCT cid, grad_day FROM feed) AS days JOIN term
            ON year(grad_day) = year(GAS_start_date)
        WHERE grad_day BETWEEN GAS_start_date AND GAS_end_date
            AND GAS_Name <> 'TEST ONLY  WINTER PREV AT'
    ),
    mapped AS (
        SELECT DISTINCT feed.*, GAS_id, GAS_Name, academic_year_c, term_calendar
        FROM feed JOIN near USING (cid, grad_day)
        WHERE nearness = 1 OR nearness = 2
    )"""


def degrees(four_year: bool, create: bool) -> str:
    record_filter = "AND NOT graduated_4_year_degree_c" if four_year else ""
    if not four_year and not create:
        record_filter = "AND type_of_degree_earned_c IS NULL"
    open_filter = "" if four_year else "AND type_of_degree_earned_c IS NULL"
    label = "label_b" if four_year and create else "label_u"
    keys = "GAS_id, Contact_Id" if create else "AT_Id"
    shared = f"""
    {_CROSSWALK}, {_mapped(four_year)}, {_MAJOR_LABELS.replace('labels(major,', 'labels(label_for,')},
    records AS (
        SELECT *, upper(Contact_Id) AS rid
        FROM student_term
        WHERE indicator_completed_ct_hs_program_c
            AND {STATUS_NAME} IN ('Active: Post-Secondary', 'Inactive: Post-Secondary')
            AND AT_record_type_name = 'College/University Semester' {record_filter}
    ),"""
    if create:
        candidates = f"""
    candidates AS (
        SELECT DISTINCT Contact_Id, full_name_c, {STATUS_NAME}, site_short, grad_day,
            m.GAS_id, m.GAS_Name, term_calendar, academic_year_c, calendar, account_name,
            College_Name, kind_rank, title, major, unit, account_id
        FROM records r JOIN mapped m ON m.cid = r.rid
        WHERE rid NOT IN (
                SELECT cid FROM mapped JOIN records
                    ON cid = rid AND mapped.GAS_id = global_academic_semester_c)
            AND College_State = billing_state_code {open_filter}
    ),
    aligned AS (SELECT * FROM candidates WHERE term_calendar = calendar),"""
    else:
        candidates = f"""
    candidates AS (
        SELECT DISTINCT Contact_Id, AT_Id, AT_Name, global_academic_semester_c, account_id,
            full_name_c, site_short, {STATUS_NAME}, College_Name, calendar, unit, grad_day, title,
            major, term_calendar
        FROM records r JOIN mapped m ON m.cid = r.rid AND m.GAS_id = r.global_academic_semester_c
    ),
    aligned AS (
        SELECT * FROM candidates
        WHERE term_calendar = calendar OR (calendar = 'Semester' AND AT_Name LIKE '%Quarter%')
    ),"""
    rows = f"""
    schooled AS (
        SELECT a.*, s.account_id AS school_id, s.account_name AS school_name,
            CASE WHEN title LIKE '%CERTIF%' THEN 'Certificate' ELSE '2-year degree' END AS kind,
            {label} AS label
        FROM aligned a LEFT JOIN school_account s ON unit = s.ipeds_id_c
            LEFT JOIN labels ON major = label_for
    ),
    lists AS (
        SELECT {keys},
            string_agg(label, '|' ORDER BY grad_day NULLS FIRST, title NULLS FIRST,
                major NULLS FIRST) AS labels,
            string_agg(title, '|' ORDER BY grad_day NULLS FIRST, title, major NULLS FIRST) AS titles,
            string_agg(major, '|' ORDER BY grad_day NULLS FIRST, title NULLS FIRST, major) AS majors,
            string_agg(CAST(grad_day AS VARCHAR), '|' ORDER BY grad_day) AS days,
            string_agg(kind, '|' ORDER BY kind) AS kinds,
            min(kind) AS best_kind, min({'kind_rank' if create else '1'}) AS best_rank
        FROM schooled GROUP BY {keys}
    )"""
    kept = ""
    if not four_year:
        kept = "WHERE kind = best_kind" + (" AND kind_rank = best_rank" if create else "")
    degree = "'4-year degree'" if four_year else "split_part(kinds, '|', 1)"
    if create:
        listed = "labels AS list_sfdc_major," if four_year else ""
        graduated = "split_part(days, '|', 1)" if four_year else "CAST(grad_day AS VARCHAR)"
        fields = f"""full_name_c, site_short, school_name AS for_prod_college_name, {listed}
            GAS_Name, {graduated} AS nsc_graduation_date, College_Name AS nsc_college_name,
            titles AS {'nsc_degree' if four_year else 'nsc_degree_earned'}, majors AS nsc_major,
            Contact_Id AS Student__c, {STATUS_NAME} AS student_audit_status__c,
            {STATUS_NAME} AS ct_status_at_c, '01246000000RNnHAAW' AS RecordTypeId,
            GAS_id AS Global_Academic_Semester__c, academic_year_c AS Academic_Year__c,
            GAS_Name || ' ' || full_name_c AS Name, school_id AS School__c,
            split_part(labels, '|', 1) AS Major__c, {degree} AS Type_of_Degree_Earned__c"""
    else:
        listed = "" if four_year else "kinds AS list_sfdc_degrees,"
        earned = "Type_of_Degree_Earned__c" if four_year else "type_of_degree_earned_c"
        fields = f"""Contact_Id, full_name_c, site_short, school_name AS for_prod_college_name,
            labels AS list_sfdc_major, AT_Name, global_academic_semester_c AS PAT_GAS_id, {listed}
            CAST(grad_day AS VARCHAR) AS nsc_graduation_date, College_Name AS nsc_college_name,
            titles AS nsc_degree, majors AS nsc_major, AT_Id AS Id, school_id AS School__c,
            split_part(labels, '|', 1) AS Major__c, {degree} AS {earned}"""
    return with_sources(
        _DEGREE_SOURCES,
        f"WITH {shared}{candidates}{rows} SELECT DISTINCT {fields} FROM schooled "
        f"JOIN lists USING ({keys}) {kept}",
    )


_ENROLLED = f"""
    record AS (
        SELECT s.*, upper(Contact_Id) AS rid, t.academic_calendar_category_c, a.ipeds_id_c,
            a.school_permanently_closed_c, a.academic_calendar_value_c
        FROM student_term s LEFT JOIN term t ON s.global_academic_semester_c = t.GAS_id
            LEFT JOIN school_account a ON s.school_account_18_id_c = a.account_id
        WHERE AT_record_type_name = 'College/University Semester'
    ),
    state AS (
        SELECT DISTINCT rid AS state_id, {STATUS_NAME} AS state_status,
            years_since_hs_grad_c AS state_years
        FROM record
    ),
    spans AS (
        SELECT nsc_feed.*, state_status, state_years, CAST(UNITID AS VARCHAR) AS unit, INSTNM,
            replace(Requester_Return_Field, '_', '') AS cid,
            CAST(strptime(CAST(Enrollment_Begin AS VARCHAR), '%Y%m%d') AS DATE) AS first_day,
            CAST(strptime(CAST(Enrollment_End AS VARCHAR), '%Y%m%d') AS DATE) AS last_day,
            CASE Enrollment_Status WHEN 'F' THEN 'Full-time' ELSE 'Part-time' END AS ft_pt
        FROM nsc_feed
            LEFT JOIN state ON replace(Requester_Return_Field, '_', '') = state_id
            LEFT JOIN scorecard
                ON ltrim(split_part(College_Code_Branch, '-', 1), '0') = OPEID6
        WHERE Record_Found_Y_N AND Enrollment_Status IN ('F', 'Q', 'H', 'L')
    ),
    near AS (
        SELECT *,
            dense_rank() OVER (PARTITION BY first_day, last_day
                ORDER BY abs(date_diff('day', first_day, GAS_start_date))) AS start_rank,
            dense_rank() OVER (PARTITION BY first_day, last_day
                ORDER BY abs(date_diff('day', last_day, GAS_end_date))) AS end_rank
        FROM (SELECT DISTINCT first_day, last_day FROM spans) AS s
            JOIN term ON year(first_day) = year(GAS_start_date) AND last_day <= GAS_end_date
    ),
    levels(code, level) AS (VALUES
        ('F', 'Undergraduate'), ('S', 'Undergraduate'), ('J', 'Undergraduate'),
        ('R', 'Undergraduate'), ('C', 'Undergraduate'), ('N', 'Undergraduate'),
        ('B', 'Undergraduate'), ('A', 'Associate''s'), ('M', 'Graduate'), ('D', 'Graduate'),
        ('P', 'Graduate'), ('L', 'Graduate'), ('G', 'Graduate or Professional'),
        ('T', 'Graduate or Post-Bacc'))
"""


def discrepancies(same_college: bool) -> str:
    indicator = (
        ""
        if same_college
        else """CASE WHEN ft_pt <> AT_Enrollment_Status_c THEN 1 ELSE 0 END
            AS indicator_enrollment_discr,"""
    )
    return with_sources(
        _DEGREE_SOURCES + " user",
        f"""
    WITH {_ENROLLED},
    found AS (
        SELECT DISTINCT record.* EXCLUDE (GAS_Name_short, GAS_start_date, GAS_end_date, GAS_Name,
                type_of_degree_earned_c),
            record.GAS_Name AS record_term, record.GAS_start_date AS record_start,
            record.GAS_end_date AS record_end, spans.*
        FROM record JOIN spans ON rid = cid
            JOIN near ON near.first_day = spans.first_day AND near.last_day = spans.last_day
                AND start_rank = 1 AND end_rank = 1
                AND near.GAS_id = record.global_academic_semester_c
    )
    SELECT {indicator} Contact_Id, AT_Id, full_name_c, high_school_graduating_class_c, site_short,
        {STATUS_NAME}, years_since_hs_grad_c, academic_year_4_year_degree_earned_c, AT_Name,
        CAST(first_day AS VARCHAR) AS nsc_enrollment_start,
        CAST(last_day AS VARCHAR) AS nsc_enrollment_end,
        AT_School_Name, College_Name AS nsc_college_name, AT_Enrollment_Status_c,
        Enrollment_Status AS nsc_enrollment_status, ft_pt AS nsc_enrollment_status_ft_pt,
        CAST(year(first_day) AS INTEGER) AS nsc_Year, Class_Level,
        coalesce(level, 'Error') AS Class, Enrollment_Major_1, Enrollment_Major_2, Graduated_,
        CAST(Graduation_Date AS VARCHAR) AS Graduation_Date, Degree_Title, Degree_Major_1, Degree_Major_2, Degree_Major_3,
        Degree_Major_4, user_name AS cc_advisor, CAST(is_active AS VARCHAR) AS active_user,
        cc_advisor_c AS cc_advisor_user_id,
        academic_calendar_value_c AS sfdc_college_academic_calendar, academic_calendar_category_c,
        CAST(record_start AS VARCHAR) AS GAS_start_date, CAST(record_end AS VARCHAR) AS GAS_end_date,
        record_term AS GAS_Name, school_account_18_id_c, school_permanently_closed_c
    FROM found LEFT JOIN "user" ON cc_advisor_c = user_id LEFT JOIN levels ON Class_Level = code
    WHERE AT_Enrollment_Status_c NOT IN ('Full-time', 'Part-time')
        AND ipeds_id_c {'=' if same_college else '<>'} unit
    """,
    )


_COUNTS = """
    counts AS (
        SELECT CAST(first_day AS VARCHAR) || ' to ' || CAST(last_day AS VARCHAR) AS label,
            first_day, last_day, GAS_Name_short, CAST(start_rank AS INTEGER) AS start_rank,
            CAST(end_rank AS INTEGER) AS end_rank, count(*) AS num_terms
        FROM near GROUP BY ALL
    )
"""

SPAN_COUNTS = with_sources(
    _DEGREE_SOURCES,
    f"""
    WITH {_ENROLLED}, {_COUNTS}
    SELECT label AS nsc_date_concat, CAST(first_day AS VARCHAR) AS nsc_enrollment_start,
        CAST(last_day AS VARCHAR) AS nsc_enrollment_end, GAS_Name_short, start_rank, end_rank,
        num_terms
    FROM counts
    """,
)

FEED_TO_TERM_SHORT = with_sources(
    _DEGREE_SOURCES,
    f"""
    WITH {_ENROLLED}, {_COUNTS}
    SELECT DISTINCT label AS nsc_date_concat, cid AS contact_id_nsc, First_Name AS first_name_nsc,
        Last_Name AS last_name_nsc, Record_Found_Y_N, Search_Date,
        ltrim(split_part(College_Code_Branch, '-', 1), '0') AS nsc_college_code_branch,
        College_Name, College_State, _2_year___4_year, Public___Private,
        CAST(spans.first_day AS VARCHAR) AS nsc_enrollment_start,
        CAST(spans.last_day AS VARCHAR) AS nsc_enrollment_end,
        CAST(year(spans.first_day) AS INTEGER) AS nsc_Year,
        Enrollment_Status AS nsc_enrollment_status, ft_pt AS nsc_enrollment_status_ft_pt,
        College_Sequence, Class_Level, coalesce(level, 'Error') AS Class, Enrollment_Major_1,
        Enrollment_Major_2, Graduated_, CAST(Graduation_Date AS VARCHAR) AS Graduation_Date, Degree_Title,
        Degree_Major_1,
        Degree_Major_2, Degree_Major_3, Degree_Major_4, state_status AS sfdc_ct_status,
        state_years AS sfdc_years_since_hs_grad, INSTNM AS cs_college_name, unit AS cs_ipeds_id,
        CASE WHEN unit IS NOT NULL THEN ltrim(split_part(College_Code_Branch, '-', 1), '0') END
            AS cs_college_branch_code_6,
        GAS_Name_short, start_rank, end_rank, num_terms
    FROM spans JOIN counts ON spans.first_day = counts.first_day
            AND spans.last_day = counts.last_day
        LEFT JOIN levels ON Class_Level = code
    WHERE start_rank = 1 AND end_rank = 1
    """,
)

_CURRENT = f"""
    current AS (
        SELECT *, CASE WHEN AT_Name LIKE '%(Semester)%' THEN 'Semester'
            WHEN AT_Name LIKE '%(Quarter)%' THEN 'Quarter' ELSE 'Check' END AS calendar
        FROM student_term
        WHERE current_as_c AND ({STATUS_CODE} = '15A' OR ({STATUS_CODE} IN ('16A', '17A')
            AND indicator_years_since_hs_graduation_c < 5.99e0))
    )
"""


def next_term(season: str, start: str) -> str:
    def keep(column: str, condition: str, name: str | None = None) -> str:
        return f"CASE WHEN {condition} THEN {column} END AS {name or column}"

    active = f"{STATUS_CODE} = '15A'"
    majors = ["major_c", "major_other_c", "second_major_c", "minor_c"]
    enrolment = "enrollment_status_c"
    if season == "Fall":
        enrolment = f"coalesce({enrolment}, persistence_at_prev_enrollment_status_c)"
    same_year = "TRUE" if season != "Fall" else "FALSE"
    fields = [
        "t.GAS_Name AS gas_name_to_create",
        "Contact_Id AS contact_id",
        STATUS_CODE,
        "AT_Id AS previous_academic_semester_c",
        "t.academic_year_c",
        "t.GAS_id",
        *[keep(m, active) for m in majors],
        keep(enrolment, active, "enrollment_status_c"),
        keep(
            "cumulative_credits_awarded_most_recent_c",
            f"{STATUS_CODE} = '16A'",
            "Cumulative_Credits_Awarded_All_Terms",
        ),
        *[keep(c, f"{STATUS_CODE} <> '17A'") for c in ("school_c", "cc_advisor_at_user_id_c")],
        "t.term_c NOT IN ('Winter', 'Summer') AS missing_advising_rubric_career_v_2_c",
        *[
            f"t.term_c <> 'Summer' AS missing_advising_rubric_{r}_v_2_c"
            for r in ("financial", "wellness", "academic")
        ],
        *RUBRIC_CARRIED,
        keep("financial_aid_package_c", same_year),
        keep("filing_status_c", same_year, "filing_status__c"),
        "'01246000000RNnHAAW' AS record_type_id",
    ]
    return with_sources(
        "student_term term",
        f"""
    WITH {_CURRENT}
    SELECT {', '.join(fields)}
    FROM current JOIN term t ON t.GAS_start_date = DATE '{start}'
        AND calendar = t.academic_calendar_category_c
    WHERE current.GAS_Name <> t.GAS_Name
    """,
    )


NEXT_TERM_AUDIT = (
    "SELECT gas_name_to_create, count(contact_id) AS n_students, count(*) AS n_records FROM ("
    + next_term("Fall", "1999-07-01")
    + ") AS records GROUP BY gas_name_to_create"
)

UNKNOWN_CALENDARS = with_sources(
    "student_term",
    f"""
    WITH {_CURRENT}
    SELECT AT_Id AS record_id, calendar AS school_calendar FROM current WHERE calendar = 'Check'
    """,
)

_NOT_ACTIVE = "current_ct_status_c IS NOT NULL AND current_ct_status_c <> 'Active'"
_ALUMNI = "current_ct_phase_c = 'Alumni'"

NEXT_ENROLMENTS = with_sources(
    "term_enrolment scholar academic_term year_enrolment",
    f"""
    SELECT t.at_name AS at_name_to_create, e.account_id, ct_status_ate_c,
        ate_id AS previous_academic_term_enrollment_c, aye_id AS academic_year_enrollment_c,
        t.at_id, t.ay_id, 'Undergraduate' AS student_academic_level, ct_case_c, contact_id,
        owner_id, CAST(at_start_date AS VARCHAR) AS enrollment_date,
        CAST(at_end_date AS VARCHAR) AS exit_date, concurrent_school_enrolled_c,
        {', '.join(
            f"CASE WHEN NOT ({_NOT_ACTIVE}) THEN {c} END AS {c}"
            for c in ("major_category_c", "major_c", "second_major_category_c",
                      "second_major_c", "minor_c")
        )},
        CASE WHEN NOT ({_NOT_ACTIVE}) THEN ate_enrollment_status END AS enrollment_status,
        CASE WHEN NOT ({_NOT_ACTIVE}) THEN most_recent_num_cumulative_credits_pc END
            AS cumulative_credits_awarded_all_terms_c,
        CASE WHEN NOT ({_ALUMNI}) THEN ate_school_id END AS school_c,
        CASE WHEN NOT ({_ALUMNI}) THEN ct_coach_ate_c END AS ct_coach_ate_c
    FROM term_enrolment e LEFT JOIN scholar s ON e.account_id = s.account_id
        JOIN academic_term t ON t.at_start_date = DATE '1999-07-01'
            AND academic_calendar_ate_c = academic_calendar_c
        LEFT JOIN year_enrolment y ON y.account_id = e.account_id AND y.ay_id = t.ay_id
    WHERE current_at_c AND (
        (current_ct_phase_c = 'Post Secondary' AND (current_ct_status_c = 'Active'
            OR current_ct_status_c = 'Inactive' AND years_since_high_school_graduation_ate_c < 5.99e0))
        OR (current_ct_phase_c = 'Alumni' AND years_since_high_school_graduation_ate_c < 5.99e0))
    """,
)


NEXT_ENROLMENT_AUDIT = (
    "SELECT at_name_to_create, count(contact_id) AS n_students, count(*) AS n_records FROM ("
    + NEXT_ENROLMENTS
    + ") AS records GROUP BY at_name_to_create"
)

UNMATCHED_CALENDARS = with_sources(
    "term_enrolment academic_term",
    """
    SELECT ate_id, academic_calendar_ate_c
    FROM term_enrolment
    WHERE current_at_c AND (
        (current_ct_phase_c = 'Post Secondary' AND (current_ct_status_c = 'Active'
            OR current_ct_status_c = 'Inactive' AND years_since_high_school_graduation_ate_c < 5.99e0))
        OR (current_ct_phase_c = 'Alumni' AND years_since_high_school_graduation_ate_c < 5.99e0))
        AND NOT EXISTS (SELECT 1 FROM academic_term
            WHERE at_start_date = DATE '1999-04-01' AND academic_calendar_c = academic_calendar_ate_c)
    """,
)


def activities(key: str, visits: str, visit_key: str, condition: str) -> str:
    return with_sources(
        f"engagement contact {visits}",
        f"""
    SELECT student_c, full_name_c, site_short AS "Site", region_short AS "Region",
        program_participation_status_c AS "Program_Participation_Status", v.Account,
        id AS "Career_Readiness_Engagement", '0121M000001cnVtQAI' AS recordtypeid,
        v.Account_ID AS "Event_Specific_Organization", CAST(v.DATE AS VARCHAR) AS "Date",
        v.type_of_event AS "Type_of_Event"
    FROM engagement LEFT JOIN contact ON student_c = contact.contact_id
        LEFT JOIN {visits} v ON {key} = v.{visit_key}
    WHERE record_type_id = '0121M000001cnVvQAI' AND global_academic_year_c = 'a1b46000000dRRAAA2'
        AND program_participation_status_c = 'Interviewed, offered, and accepted' AND {condition}
    """,
    )


NEW_APPLICATIONS = with_sources(
    "application_template school_account application_fact",
    """
    SELECT Full_Name, Site AS site__c, College_University AS college_name, _18_Digit_ID AS id,
        account_id AS college_university__c, Application_Status AS application_status__c,
        Admission_Status AS admission_status__c,
        Requested_application_fee_waiver AS "Requested_application_fee_waiver__c",
        Application_fee_waiver_granted_ AS "Application_fee_waiver_granted__c",
        Requested_Application_Fee_Payment_ AS "Requested_Application_Fee_Payment__c"
    FROM application_template t LEFT JOIN school_account ON College_University = account_name
        LEFT JOIN application_fact f
            ON _18_Digit_ID = f.contact_id AND College_University = f.college_name
    WHERE EditTracker > 0 AND College_University IS NOT NULL AND Application_Status IS NOT NULL
        AND college_app_id IS NULL
    """,
)

ADMISSION_EDITS = with_sources(
    "admission_template school_account",
    """
    SELECT Full_Name, Site AS site__c, College_University__Account_Name AS college_name,
        College_Application__ID AS id, Application_Status AS application_status__c,
        Admission_Status AS admission_status__c, Enrollment_Deposit AS enrollment_deposit__c,
        Housing_Application AS housing_application__c,
        Financial_Aid_Verification_Status AS verification_status__c,
        Award_Letter AS award_letter__c
    FROM admission_template
        LEFT JOIN school_account ON College_University__Account_Name = account_name
    WHERE EditTracker > 0 AND Admission_Status IS NOT NULL
    """,
)

AID_EDITS = with_sources(
    "aid_template",
    """
    SELECT Full_Name, grade, Site AS site__c, _18_Digit_ID AS id,
        FA_Req__FAFSA_Alternative_Financial_Aid AS "FA_Req__FAFSA_Alternative_Financial_Aid__c",
        FA_Req__EFC_Source AS "FA_Req__EFC_Source__c",
        FA_Req__Exp_Financial_Contribution__EFC_
            AS "FA_Req__Exp_Financial_Contribution__EFC__c",
        FA_Req__Annual_Adjusted_Gross_Income AS "FA_Req__Annual_Adjusted_Gross_Income__c"
    FROM aid_template WHERE EditTracker > 0
    """,
)

# The cleaned forms of the stand-in names, written out.
SUBMISSION = with_sources(
    "contact",
    """
    WITH firsts(raw, first_name, initial) AS (VALUES
        ('Ana M.', 'Ana ', 'M'), ('A''kira', 'A kira', NULL), ('José', 'José', NULL),
        ('Zoë é.', 'Zoë ', 'É'), ('J.R.', '', 'J'), ('Li', 'Li', NULL),
        ('Mary-Ann', 'Mary-Ann', NULL), ('Bob Q. T.', 'Bob  ', 'Q')),
    lasts(raw, last_name, suffix) AS (VALUES
        ('Smith III', 'Smith ', 'III'), ('Lee Jr.', 'Lee ', 'Jr'), ('LeeIV', 'Lee', 'IV'),
        ('O''Neil', 'O Neil', NULL), ('José', 'José', NULL), ('Smith-Jones', 'Smith-Jones', NULL),
        ('Núñez V', 'Núñez ', 'V'), ('Müller', 'Müller', NULL), ('d''Arc IX', 'd Arc ', 'IX'),
        ('Ng', 'Ng', NULL), ('Jrx', '', 'Jrx'), ('Val VIII', 'Val ', 'VIII')),
    middles(raw, initial) AS (VALUES
        ('d4vid!', 'D'), ('ángel', 'Á'), ('Lee', 'L'), ('o''b', 'O'))
    SELECT 0 AS place, 'H1,693622,0,Some School,20230308,DA,S,,,,00,' AS line
    UNION ALL
    SELECT 1 AS place, 'D1,,' || firsts.first_name || ','
        || coalesce(firsts.initial, middles.initial, '') || ',' || lasts.last_name || ','
        || coalesce(lasts.suffix, '') || ',' || coalesce(strftime(birthdate, '%Y%m%d'), '') || ','
        || coalesce(CAST(high_school_graduating_class_c AS VARCHAR) || '0601', '') || ',,,00,'
        || contact_id AS line
    FROM contact JOIN firsts ON contact.first_name = firsts.raw
        JOIN lasts ON contact.last_name = lasts.raw
        LEFT JOIN middles ON contact.middle_name = middles.raw
    WHERE indicator_completed_ct_hs_program_c
    """,
)

#: A fiftieth or so of the feed with a graduation date that is none, as (condition, text) in SQL of
#: both engines: a month beyond twelve, day 0, seven digits, words.
BAD_DATES = [
    ("Enrollment_Begin % 97 = 0", "CAST(Graduation_Date + 5000 AS STRING)"),
    ("Enrollment_Begin % 97 = 1", "CAST(Graduation_Date - Graduation_Date % 100 AS STRING)"),
    ("Enrollment_Begin % 97 = 2", "substr(CAST(Graduation_Date AS STRING), 1, 7)"),
    ("Enrollment_Begin % 97 = 3", "'unknown'"),
]
MALFORMED_DATE = (
    "CASE WHEN Graduation_Date IS NULL THEN NULL "
    + " ".join(f"WHEN {condition} THEN {text}" for condition, text in BAD_DATES)
    + " ELSE CAST(Graduation_Date AS STRING) END"
)

FEED_REJECTS = with_sources(
    "nsc_feed",
    f"""
    WITH cells AS (SELECT *, {MALFORMED_DATE} AS cell FROM nsc_feed)
    SELECT Requester_Return_Field, College_Code_Branch, 'Graduation_Date' AS "column", cell AS found,
        CASE WHEN try_cast(cell AS BIGINT) IS NULL THEN 'not a bigint' ELSE 'not a date' END AS problem
    FROM cells
    WHERE cell IS NOT NULL AND (len(cell) <> 8 OR try_strptime(cell, '%Y%m%d') IS NULL)
    """,
)


def degrees_of_good_rows() -> str:
    bad = " OR ".join(condition for condition, _ in BAD_DATES)
    good = f"(SELECT * FROM nsc_feed WHERE Graduation_Date IS NULL OR NOT ({bad})) AS good_feed"
    return degrees(four_year=True, create=False).replace("FROM nsc_feed", f"FROM {good}", 1)


_TRACKED = """
    counted AS (
        SELECT sheet, "row", "user", CASE WHEN "row" > 1 AND sheet <> 'Aid' THEN 1 ELSE 0 END
                AS stamped, ts, seq
        FROM edit_log
        WHERE sheet <> 'READ' AND "user" <> 'u3'
            AND ((coalesce(new_value, '') <> '' AND coalesce(old_value, '') <> new_value)
                OR (coalesce(old_value, '') <> '' AND coalesce(new_value, '') = ''))
    ),
    tracked AS (
        SELECT sheet, "row", '1' AS "EditTracker",
            CASE WHEN stamped = 1 THEN "user" END AS "User"
        FROM (
            SELECT *, row_number() OVER (PARTITION BY sheet, "row" ORDER BY ts DESC, seq DESC) AS n
            FROM counted
        ) AS edits
        WHERE n = 1
    )
"""

TRACKED = with_sources("edit_log", f"WITH {_TRACKED} SELECT * FROM tracked")

STAMPED = with_sources(
    "edit_log application_template",
    f"""
    WITH {_TRACKED}
    SELECT t."row", Full_Name, 1 AS "EditTracker", tracked."User"
    FROM application_template t JOIN tracked ON t."row" = tracked."row" AND sheet = 'Applications'
    """,
)

EDITED_APPLICATIONS = with_sources(
    "edit_log application_template school_account application_fact",
    f"""
    WITH {_TRACKED}
    SELECT Full_Name, Site AS site__c, College_University AS college_name, _18_Digit_ID AS id,
        account_id AS college_university__c, Application_Status AS application_status__c,
        Admission_Status AS admission_status__c,
        Requested_application_fee_waiver AS "Requested_application_fee_waiver__c",
        Application_fee_waiver_granted_ AS "Application_fee_waiver_granted__c",
        Requested_Application_Fee_Payment_ AS "Requested_Application_Fee_Payment__c"
    FROM application_template t
        LEFT JOIN tracked ON t."row" = tracked."row" AND sheet = 'Applications'
        LEFT JOIN school_account ON College_University = account_name
        LEFT JOIN application_fact f
            ON _18_Digit_ID = f.contact_id AND College_University = f.college_name
    WHERE (tracked."row" IS NOT NULL OR t.EditTracker > 0) AND College_University IS NOT NULL
        AND Application_Status IS NOT NULL AND college_app_id IS NULL
    """,
)

# The stand-in majors that no rule names, written out.
SENTINELS = with_sources(
    "nsc_feed student_term",
    f"""
    WITH {_CURRENT}, levels(code) AS (VALUES {", ".join(f"('{c}')" for c in "FSJRCNBAMDPLGT")})
    SELECT 'Class' AS checked, count(*) FILTER (WHERE code IS NULL) AS n
    FROM nsc_feed LEFT JOIN levels ON Class_Level = code
    WHERE Record_Found_Y_N AND Enrollment_Status IN ('F', 'Q', 'H', 'L')
    UNION ALL
    SELECT 'school_calendar' AS checked, count(*) FILTER (WHERE calendar = 'Check') AS n FROM current
    UNION ALL
    SELECT 'sfdc_major' AS checked, count(*) FILTER (
        WHERE Degree_Major_1 IN ('MULTIMEDIA', 'COMMUNICATION', 'GENERAL', 'BASKETRY')) AS n
    FROM nsc_feed
    """,
)
