"""Types of the products' columns, which the checking SQL sees as text."""

import pytest

from catalogue import product_queries

SF = "/root/testdata/sf0.001"
_ENROLMENT = (
    "years_since_hs_grad_c double, nsc_enrollment_start date, nsc_enrollment_end date, nsc_Year int, "
    "Graduated_ boolean, Graduation_Date bigint, active_user boolean, GAS_start_date date, GAS_end_date date, "
    "school_permanently_closed_c boolean"
)
#: Columns that aren't text, in order.
TYPED = {
    "degree_4yr_update": "nsc_graduation_date date",
    "degree_4yr_create": "",
    "degree_2yr_update": "nsc_graduation_date date",
    "degree_2yr_create": "nsc_graduation_date date",
    "enrolment_discrepancy": _ENROLMENT,
    "enrolment_and_college_discrepancy": "indicator_enrollment_discr int, " + _ENROLMENT,
    "span_term_count": (
        "nsc_enrollment_start date, nsc_enrollment_end date, start_rank int, end_rank int, num_terms bigint"
    ),
    "feed_term_short": (
        "Record_Found_Y_N boolean, Search_Date bigint, nsc_enrollment_start date, nsc_enrollment_end date, "
        "nsc_Year int, College_Sequence int, Graduated_ boolean, Graduation_Date bigint, "
        "sfdc_years_since_hs_grad double, num_terms bigint, start_rank int, end_rank int"
    ),
    "next_term_fall": (
        "Cumulative_Credits_Awarded_All_Terms double, missing_advising_rubric_career_v_2_c boolean, "
        "missing_advising_rubric_financial_v_2_c boolean, missing_advising_rubric_wellness_v_2_c boolean, "
        "missing_advising_rubric_academic_v_2_c boolean"
    ),
    "next_term_enrolment": (
        "enrollment_date date, exit_date date, cumulative_credits_awarded_all_terms_c double"
    ),
    "region_visit_fanout": "Date date",
    "student_schedule": "Date date",
    "changed_rows_new_only": "",
    "admission_edit_rows": "",
    "aid_edit_rows": (
        "FA_Req__Exp_Financial_Contribution__EFC__c double, FA_Req__Annual_Adjusted_Gross_Income__c double"
    ),
}


@pytest.mark.parametrize("name", TYPED)
def test_types(compiled, name):
    df = getattr(product_queries, name)(compiled, SF)
    assert ", ".join(f"{c} {kind}" for c, kind in df.dtypes if kind != "string") == TYPED[name]


def test_order_of_short_term_names(compiled):
    columns = product_queries.feed_term_short(compiled, SF).columns
    assert columns[0] == "contact_id_nsc"
    assert columns[-4:] == ["GAS_Name_short", "num_terms", "start_rank", "end_rank"]
