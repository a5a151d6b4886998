"""The batch file of students to look up at the clearinghouse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.functions.dates import compact_date, search_date
from termweave.functions.names import (
    middle_initial,
    name_suffix,
    plain_name,
    without_initials,
    without_suffix,
)
from termweave.sources.sinks import write_positional


@dataclass(frozen=True)
class SubmissionSpec:
    """Who submits, and when."""

    organisation: str
    # Account number, branch and date of the header record.
    account: str = "693622"
    branch: str = "0"
    created: str = "20230308"


FIELDS = [f"f{i:02d}" for i in range(1, 13)]


def cleaned_contacts(contacts: DataFrame) -> DataFrame:
    """Programme completers with names, birth date and search date in file format."""
    first, last = F.col("first_name"), F.col("last_name")
    return contacts.where("indicator_completed_ct_hs_program_c").select(
        "contact_id",
        plain_name(without_initials(first)).alias("first_name"),
        middle_initial(first, F.col("middle_name")).alias("middle_initial"),
        plain_name(without_suffix(last)).alias("last_name"),
        name_suffix(last).alias("suffix"),
        compact_date(F.col("birthdate")).alias("birthdate"),
        search_date(F.col("high_school_graduating_class_c")).alias("search_date"),
    )


def clearinghouse_submission(contacts: DataFrame) -> DataFrame:
    """Detail records, twelve fields by position."""
    # Record mark and the constant eleventh field.
    blank = F.lit(None).cast("string")
    values = [
        F.lit("D1"),
        blank,
        F.col("first_name"),
        F.col("middle_initial"),
        F.col("last_name"),
        F.col("suffix"),
        F.col("birthdate"),
        F.col("search_date").cast("string"),
        blank,
        blank,
        F.lit("00"),
        F.col("contact_id"),
    ]
    return cleaned_contacts(contacts).select([v.alias(f) for v, f in zip(values, FIELDS)])


def header_record(details: DataFrame, spec: SubmissionSpec) -> DataFrame:
    # Layout of the header record.
    values = ["H1", spec.account, spec.branch, spec.organisation, spec.created, "DA", "S"]
    values += ["", "", "", "00", ""]
    return details.sparkSession.range(1, numPartitions=1).select(
        [F.lit(v).alias(f) for v, f in zip(values, FIELDS)]
    )


def submission_records(contacts: DataFrame, spec: SubmissionSpec) -> DataFrame:
    """The whole file: ``place`` 0 is the header record, 1 are detail records in any order."""
    details = clearinghouse_submission(contacts)
    header = header_record(details, spec)
    return header.select(F.lit(0).alias("place"), *FIELDS).union(details.select(F.lit(1).alias("place"), *FIELDS))


def record_line(fields: list[str] = FIELDS) -> Column:
    """A record as the line that the file has for it; blank fields stay blank, quotes are doubled."""
    text = [F.coalesce(F.col(f), F.lit("")) for f in fields]
    quoted = [
        F.when(t.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(t)
        for t in text
    ]
    return F.concat_ws(",", *quoted)


def write_submission(contacts: DataFrame, path: str, spec: SubmissionSpec) -> None:
    """The header record and all detail records as parts of one file.

    The header is the first partition, so it opens the first part; the parts in name order
    make up the file. No shuffle, and no task sees more than its input split.
    """
    write_positional(submission_records(contacts, spec).drop("place"), path)
