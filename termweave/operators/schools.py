"""Colleges of the feed and the school accounts of the CRM.

The feed names a college by branch code, the scorecard maps a code to one or more IPEDS
ids, and an IPEDS id can belong to several accounts. Which side of these joins is broadcast
is left to Catalyst, which compares the sizes of the two dimensions with
``spark.sql.autoBroadcastJoinThreshold`` and shuffles past it.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.functions.codes import normalise_calendar, school_type_rank
from termweave.functions.keys import first_word


def scorecard_codes(scorecard: DataFrame) -> DataFrame:
    """Branch code, IPEDS id as text and name of each scorecard college."""
    return scorecard.select(
        F.col("INSTNM").alias("cs_college_name"),
        F.col("UNITID").cast("string").alias("cs_ipeds_id"),
        F.col("OPEID6").alias("cs_college_branch_code_6"),
    )


def account_calendars(accounts: DataFrame) -> DataFrame:
    """Accounts with the first word of their calendar and the rank of their type."""
    return accounts.select(
        "account_id",
        "account_name",
        "academic_calendar_value_c",
        "billing_state",
        "billing_state_code",
        F.col("ipeds_id_c").alias("sfdc_ipeds"),
        school_type_rank(F.col("predominant_degree_awarded_c")).alias("rank_college_type"),
        first_word(F.col("academic_calendar_value_c")).alias("college_academic_calendar"),
    )


def school_crosswalk(accounts: DataFrame, scorecard: DataFrame) -> DataFrame:
    """Every account with the scorecard rows of its IPEDS id, if any."""
    schools, codes = account_calendars(accounts), scorecard_codes(scorecard)
    return schools.join(codes, schools.sfdc_ipeds == codes.cs_ipeds_id, "left")


def with_schools(feed: DataFrame, accounts: DataFrame, scorecard: DataFrame) -> DataFrame:
    """Feed rows × the accounts of their college, for rows that have one.

    Two inner lookups instead of one join with the crosswalk: each dimension then comes
    straight from its scan, with a size Catalyst knows, so the feed is not shuffled as long
    as they are small.
    """
    codes = scorecard_codes(scorecard)
    schools = account_calendars(accounts).withColumn(
        "college_academic_calendar", normalise_calendar(F.col("college_academic_calendar"))
    )
    return feed.join(codes, F.col("nsc_college_code_branch") == codes.cs_college_branch_code_6).join(
        schools, codes.cs_ipeds_id == schools.sfdc_ipeds
    )


def import_accounts(accounts: DataFrame) -> DataFrame:
    """Accounts as they go into an import row, by IPEDS id."""
    return accounts.select(
        F.col("account_id").alias("for_prod_account_id"),
        F.col("account_name").alias("for_prod_college_name"),
        F.col("ipeds_id_c").alias("for_prod_ipeds"),
    )
