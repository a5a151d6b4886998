"""Schemas of every source. Names and types are the contract with the CRM and the feed."""

from pyspark.sql import types as T

from termweave.sources.columns import STATUS_CODE, STATUS_NAME

# Advising fields that carry over, and those that reset in a new year.
RUBRIC_CARRIED = [
    "repayment_plan_c",
    "repayment_policies_c",
    "loan_exit_c",
    "academic_networking_50_cred_c",
    "academic_networking_over_50_credits_c",
    "exploration_career_c",
    "internship_5075_credits_c",
    "post_graduate_opportunities_75_cred_c",
    "interested_in_graduate_school_50_credits_c",
    "alumni_network_75_credits_c",
]
RUBRIC_RESET = ["financial_aid_package_c", "filing_status_c"]


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _schema(text: str) -> T.StructType:
    """A schema from ``name type, …``, without the session that Spark's DDL parser needs."""
    columns = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


def _strings(names: list[str]) -> str:
    return ", ".join(f"{name} string" for name in names)


# Column names and types of the sources.
SCHEMAS = {
    "nsc_feed": _schema(
        """
        Requester_Return_Field string, First_Name string, Last_Name string,
        Record_Found_Y_N boolean, Search_Date bigint, College_Code_Branch string,
        College_Name string, College_State string, _2_year___4_year string,
        Public___Private string, Enrollment_Begin bigint, Enrollment_End bigint,
        Enrollment_Status string, Class_Level string, Enrollment_Major_1 string,
        Enrollment_Major_2 string, Graduated_ boolean, Graduation_Date bigint,
        Degree_Title string, Degree_Major_1 string, Degree_Major_2 string,
        Degree_Major_3 string, Degree_Major_4 string, College_Sequence int
        """
    ),
    "student_term": _schema(
        f"""
        Contact_Id string, AT_Id string, AT_Name string, full_name_c string,
        site_short string, {STATUS_NAME} string, {STATUS_CODE} string,
        high_school_graduating_class_c string, school_account_18_id_c string,
        cc_advisor_c string, AT_Enrollment_Status_c string, AT_School_Name string,
        indicator_years_since_hs_graduation_c double, years_since_hs_grad_c double,
        type_of_degree_earned_c string, academic_year_4_year_degree_earned_c string,
        GAS_start_date date, GAS_end_date date, GAS_Name string, GAS_Name_short string,
        term_c string, AY_Name string, global_academic_semester_c string,
        indicator_completed_ct_hs_program_c boolean, graduated_4_year_degree_c boolean,
        current_as_c boolean, AT_record_type_name string, major_c string,
        major_other_c string, second_major_c string, minor_c string, school_c string,
        cc_advisor_at_user_id_c string, enrollment_status_c string,
        persistence_at_prev_enrollment_status_c string,
        cumulative_credits_awarded_most_recent_c double,
        {_strings(RUBRIC_CARRIED + RUBRIC_RESET)}
        """
    ),
    "term": _schema(
        """
        GAS_id string, GAS_Name string, GAS_Name_short string, academic_year_c string,
        term_c string, academic_calendar_category_c string, GAS_start_date date,
        GAS_end_date date
        """
    ),
    "school_account": _schema(
        """
        account_id string, account_name string, predominant_degree_awarded_c string,
        academic_calendar_value_c string, billing_state string, billing_state_code string,
        ipeds_id_c string, school_permanently_closed_c boolean
        """
    ),
    "scorecard": _schema("INSTNM string, UNITID bigint, OPEID6 string"),
    "user": _schema("user_id string, user_name string, is_active boolean"),
    "term_enrolment": _schema(
        """
        account_id string, contact_id string, owner_id string, ate_id string, at_id string,
        at_name string, ate_school_id string, ct_coach_ate_c string, ct_case_c string,
        concurrent_school_enrolled_c string, ct_status_ate_c string,
        ate_enrollment_status string, major_category_c string, major_c string,
        second_major_category_c string, second_major_c string, minor_c string,
        academic_calendar_ate_c string, current_ct_status_c string,
        current_ct_phase_c string, years_since_high_school_graduation_ate_c double,
        current_at_c boolean
        """
    ),
    "scholar": _schema("account_id string, most_recent_num_cumulative_credits_pc double"),
    "academic_term": _schema(
        """
        at_id string, ay_id string, at_name string, season string,
        academic_calendar_c string, at_start_date date, at_end_date date
        """
    ),
    "year_enrolment": _schema("aye_id string, ay_id string, account_id string"),
    "engagement": _schema(
        """
        id string, student_c string, organization_c string, record_type_id string,
        global_academic_year_c string, program_participation_status_c string
        """
    ),
    "contact": _schema(
        """
        contact_id string, full_name_c string, site_short string, region_short string,
        first_name string, middle_name string, last_name string, birthdate date,
        high_school_graduating_class_c int, indicator_completed_ct_hs_program_c boolean
        """
    ),
    "visit": _schema(
        """
        region_id string, contact_id string, Account string, Account_ID string,
        type_of_event string, DATE date
        """
    ),
    "application_template": _schema(
        """
        Full_Name string, Site string, College_University string, _18_Digit_ID string,
        Application_Status string, Admission_Status string,
        Requested_application_fee_waiver string, Application_fee_waiver_granted_ string,
        Requested_Application_Fee_Payment_ string, EditTracker int, User string, row int
        """
    ),
    "application_fact": _schema("college_app_id string, contact_id string, college_name string"),
    "admission_template": _schema(
        """
        Full_Name string, Site string, College_University__Account_Name string,
        College_Application__ID string, Application_Status string, Admission_Status string,
        Enrollment_Deposit string, Housing_Application string,
        Financial_Aid_Verification_Status string, Award_Letter string, EditTracker int, row int
        """
    ),
    "aid_template": _schema(
        """
        Full_Name string, grade string, Site string, _18_Digit_ID string,
        FA_Req__FAFSA_Alternative_Financial_Aid string, FA_Req__EFC_Source string,
        FA_Req__Exp_Financial_Contribution__EFC_ double,
        FA_Req__Annual_Adjusted_Gross_Income double, EditTracker int, row int
        """
    ),
    "edit_log": _schema(
        """
        sheet string, row int, column string, old_value string, new_value string,
        user string, ts timestamp, seq bigint
        """
    ),
}

# Columns that hold days as YYYYMMDD numbers.
DATE_NUMBERS = {"nsc_feed": ("Search_Date", "Enrollment_Begin", "Enrollment_End", "Graduation_Date")}
