"""Career readiness activities: accepted students × the visits planned for them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termweave.operators.importing import import_fields


@dataclass(frozen=True)
class ActivitySpec:
    """Which engagements count, and the record type of the activities."""

    # Record types, academic year and participation status in the CRM.
    engagement_type: str = "0121M000001cnVvQAI"
    academic_year: str = "a1b46000000dRRAAA2"
    participation: str = "Interviewed, offered, and accepted"
    activity_type: str = "0121M000001cnVtQAI"
    # Sites whose students have a schedule of their own.
    scheduled_sites: tuple[str, ...] = ("East Palo Alto", "Oakland", "San Francisco")


def readiness_activities(
    engagements: DataFrame,
    contacts: DataFrame,
    visits: DataFrame,
    spec: ActivitySpec = ActivitySpec(),
    by: str = "region",
) -> DataFrame:
    """Activities by the visits of the student's region, or by the student's own schedule.

    Students without a visit stay, with an empty one. Regions are not told apart here: that
    one region has student schedules instead only shows in the visits given.
    """
    if by not in ("region", "student"):
        raise ValueError(f"by: {by}")
    accepted = engagements.where(
        (F.col("record_type_id") == spec.engagement_type)
        & (F.col("global_academic_year_c") == spec.academic_year)
        & (F.col("program_participation_status_c") == spec.participation)
    )
    people = contacts.select("contact_id", "full_name_c", "site_short", "region_short")
    group = accepted.join(people, F.col("student_c") == F.col("contact_id"), "left").drop("contact_id")
    if by == "student":
        group = group.where(F.col("site_short").isin(*spec.scheduled_sites))
        key, visit_key = "student_c", "contact_id"
    else:
        key, visit_key = "organization_c", "region_id"
    planned = visits.select(
        F.col(visit_key).alias("visit_key"), "Account", "Account_ID", "type_of_event", "DATE"
    )
    rows = group.join(planned, F.col(key) == F.col("visit_key"), "left")
    return import_fields(
        rows,
        [
            ("student_c", "student_c"),
            ("full_name_c", "full_name_c"),
            ("Site", "site_short"),
            ("Region", "region_short"),
            ("Program_Participation_Status", "program_participation_status_c"),
            ("Account", "Account"),
            ("Career_Readiness_Engagement", "id"),
            ("recordtypeid", F.lit(spec.activity_type)),
            ("Event_Specific_Organization", "Account_ID"),
            ("Date", "DATE"),
            ("Type_of_Event", "type_of_event"),
        ],
    )
