"""Import rows from spreadsheets whose edited rows are flagged."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.operators.importing import import_fields


def edited(template: DataFrame, *required: str) -> DataFrame:
    """Flagged rows that are filled in far enough."""
    rows = template.where(F.col("EditTracker") > 0)
    for column in required:
        rows = rows.where(F.col(column).isNotNull())
    return rows


def _with_account(template: DataFrame, accounts: DataFrame, college: str) -> DataFrame:
    """Account by name; a name that several accounts share repeats the row."""
    names = accounts.select("account_id", "account_name")
    return template.join(names, F.col(college) == F.col("account_name"), "left")


def new_applications(template: DataFrame, accounts: DataFrame, applications: DataFrame) -> DataFrame:
    """Applications of edited rows that the CRM does not hold yet."""
    existing = applications.select(
        F.col("contact_id").alias("applied_id"), F.col("college_name").alias("applied_college")
    )
    rows = edited(template, "College_University", "Application_Status").join(
        existing,
        (F.col("_18_Digit_ID") == F.col("applied_id"))
        & (F.col("College_University") == F.col("applied_college")),
        "left_anti",
    )
    return import_fields(
        _with_account(rows, accounts, "College_University"),
        [
            ("Full_Name", "Full_Name"),
            ("site__c", "Site"),
            ("college_name", "College_University"),
            ("id", "_18_Digit_ID"),
            ("college_university__c", "account_id"),
            ("application_status__c", "Application_Status"),
            ("admission_status__c", "Admission_Status"),
            ("Requested_application_fee_waiver__c", "Requested_application_fee_waiver"),
            ("Application_fee_waiver_granted__c", "Application_fee_waiver_granted_"),
            ("Requested_Application_Fee_Payment__c", "Requested_Application_Fee_Payment_"),
        ],
    )


def admission_edits(template: DataFrame, accounts: DataFrame) -> DataFrame:
    """Admission and enrolment fields of edited rows.

    The account is not part of the import, but a shared account name repeats its rows.
    """
    rows = edited(template, "Admission_Status")
    return import_fields(
        _with_account(rows, accounts, "College_University__Account_Name"),
        [
            ("Full_Name", "Full_Name"),
            ("site__c", "Site"),
            ("college_name", "College_University__Account_Name"),
            ("id", "College_Application__ID"),
            ("application_status__c", "Application_Status"),
            ("admission_status__c", "Admission_Status"),
            ("enrollment_deposit__c", "Enrollment_Deposit"),
            ("housing_application__c", "Housing_Application"),
            ("verification_status__c", "Financial_Aid_Verification_Status"),
            ("award_letter__c", "Award_Letter"),
        ],
    )


def aid_edits(template: DataFrame) -> DataFrame:
    """Financial aid fields of edited rows."""
    return import_fields(
        edited(template),
        [
            ("Full_Name", "Full_Name"),
            ("grade", "grade"),
            ("site__c", "Site"),
            ("id", "_18_Digit_ID"),
            (
                "FA_Req__FAFSA_Alternative_Financial_Aid__c",
                "FA_Req__FAFSA_Alternative_Financial_Aid",
            ),
            ("FA_Req__EFC_Source__c", "FA_Req__EFC_Source"),
            (
                "FA_Req__Exp_Financial_Contribution__EFC__c",
                "FA_Req__Exp_Financial_Contribution__EFC_",
            ),
            ("FA_Req__Annual_Adjusted_Gross_Income__c", "FA_Req__Annual_Adjusted_Gross_Income"),
        ],
    )
