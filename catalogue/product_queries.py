"""The import products over the stand-in sources."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue import product_oracles as oracles
from catalogue.registry import query
from catalogue.scratch import remove, scratch_folder
from catalogue.standins import source
from termweave.plans.activities import readiness_activities
from termweave.plans.degrees import (
    FEED_COLUMNS,
    FOUR_YEAR_CREATE,
    FOUR_YEAR_UPDATE,
    TWO_YEAR_CREATE,
    TWO_YEAR_UPDATE,
    degree_records,
)
from termweave.functions.degrees import classify, major_rules
from termweave.plans.enrolment import (
    enrolled,
    enrolment_discrepancies,
    feed_to_term_short,
    span_term_counts,
)
from termweave.plans.next_term import (
    TermSpec,
    current_records,
    next_term_audit,
    next_term_enrolments,
    next_term_records,
    unknown_calendars,
    unmatched_calendars,
    write_next_term,
)
from termweave.operators.audit import sentinel_counts
from termweave.plans.submission import SubmissionSpec, record_line, submission_records, write_submission
from termweave.plans.templates import admission_edits, aid_edits, edited, new_applications
from termweave.session import tune
from termweave.sources.layout import (
    buckets_for,
    counts_by_student,
    read_by_student,
    stage_by_student,
    write_by_student,
)
from termweave.sources.registry import read_csv
from termweave.sources.rejects import split_rows
from termweave.sources.sinks import read_positional, write_import
from termweave.streaming.edits import (
    EditSpec,
    flags,
    stamp_template,
    start_tracking,
    track_edits,
    tracked_so_far,
)

FALL = TermSpec("Fall", date(1999, 7, 1))
SPRING = TermSpec("Spring", date(1998, 1, 1))
QUARTER = TermSpec("Spring", date(1999, 4, 1))  # no semester starts that day
EDITS = EditSpec(maintainers=("u3",), sheets_without_user=("Aid",))


def _degrees(spark, sf, spec) -> DataFrame:
    names = ["nsc_feed", "student_term", "school_account", "scorecard", "term"]
    return degree_records(*[source(spark, sf, name) for name in names], spec)


@query(oracles.degrees(four_year=True, create=False))
def degree_4yr_update(spark, sf):
    return _degrees(spark, sf, FOUR_YEAR_UPDATE)


@query(oracles.degrees(four_year=True, create=True))
def degree_4yr_create(spark, sf):
    return _degrees(spark, sf, FOUR_YEAR_CREATE)


@query(oracles.degrees(four_year=False, create=False))
def degree_2yr_update(spark, sf):
    return _degrees(spark, sf, TWO_YEAR_UPDATE)


@query(oracles.degrees(four_year=False, create=True))
def degree_2yr_create(spark, sf):
    return _degrees(spark, sf, TWO_YEAR_CREATE)


def _by_student(spark, sf, *names) -> list[DataFrame]:
    """Sources from copies that are laid out by student, in buckets as the largest needs them."""
    stages = {name: scratch_folder(spark, f"{name}-staged") for name in names}
    staged = {name: stage_by_student(source(spark, sf, name), name, stages[name]) for name in names}
    counts = {name: counts_by_student(staged[name], name) for name in names}
    buckets = buckets_for(max(rows for rows, _ in counts.values()))
    laid_out = []
    for name, (_, hottest) in counts.items():
        folder = scratch_folder(spark, name)
        table = f"{name}_{folder.rsplit('-', 1)[-1]}"
        write_by_student(staged[name], name, table, buckets, folder, hottest=hottest)
        remove(spark, stages[name])
        laid_out.append(read_by_student(spark, name, table))
    return laid_out


@query(oracles.degrees(four_year=True, create=False))
def degree_4yr_update_by_student(spark, sf):
    """From copies of the feed and the records in buckets by student, which meet without a shuffle."""
    spark = tune(spark.newSession(), by_student=True)
    laid_out = _by_student(spark, sf, "nsc_feed", "student_term")
    others = [source(spark, sf, name) for name in ("school_account", "scorecard", "term")]
    return degree_records(*laid_out, *others, FOUR_YEAR_UPDATE)


@query(oracles.discrepancies(same_college=True), ("Graduation_Date", "active_user"))
def enrolment_discrepancy_by_student(spark, sf):
    spark = tune(spark.newSession(), by_student=True)
    laid_out = _by_student(spark, sf, "nsc_feed", "student_term")
    others = [source(spark, sf, name) for name in ("school_account", "scorecard", "term", "user")]
    return enrolment_discrepancies(*laid_out, *others, True)


def _discrepancies(spark, sf, same_college) -> DataFrame:
    names = ["nsc_feed", "student_term", "school_account", "scorecard", "term", "user"]
    return enrolment_discrepancies(*[source(spark, sf, name) for name in names], same_college)


@query(oracles.discrepancies(same_college=True), ("Graduation_Date", "active_user"))
def enrolment_discrepancy(spark, sf):
    return _discrepancies(spark, sf, True)


@query(oracles.discrepancies(same_college=False), ("Graduation_Date", "active_user"))
def enrolment_and_college_discrepancy(spark, sf):
    return _discrepancies(spark, sf, False)


@query(oracles.SPAN_COUNTS)
def span_term_count(spark, sf):
    return span_term_counts(source(spark, sf, "nsc_feed"), source(spark, sf, "term"))


@query(oracles.FEED_TO_TERM_SHORT, ("Graduation_Date",))
def feed_term_short(spark, sf):
    names = ["nsc_feed", "student_term", "scorecard", "term"]
    return feed_to_term_short(*[source(spark, sf, name) for name in names])


def _next_term(spark, sf, spec) -> DataFrame:
    return next_term_records(source(spark, sf, "student_term"), source(spark, sf, "term"), spec)


@query(oracles.next_term("Fall", "1999-07-01"))
def next_term_fall(spark, sf):
    return _next_term(spark, sf, FALL)


@query(oracles.next_term("Spring", "1998-01-01"))
def next_term_spring(spark, sf):
    return _next_term(spark, sf, SPRING)


@query(oracles.NEXT_TERM_AUDIT)
def record_count_audit(spark, sf):
    return next_term_audit(_next_term(spark, sf, FALL))


@query(oracles.UNKNOWN_CALENDARS)
def next_term_unknown_calendar(spark, sf):
    rows = unknown_calendars(source(spark, sf, "student_term"))
    return rows.select(F.col("AT_Id").alias("record_id"), "school_calendar")


def _next_enrolments(spark, sf) -> DataFrame:
    names = ["term_enrolment", "scholar", "academic_term", "year_enrolment"]
    return next_term_enrolments(*[source(spark, sf, name) for name in names], FALL)


@query(oracles.NEXT_ENROLMENTS)
def next_term_enrolment(spark, sf):
    return _next_enrolments(spark, sf)


@query(oracles.NEXT_TERM_AUDIT)
def record_count_observed(spark, sf):
    """The same counts, taken while the import is written."""
    terms = source(spark, sf, "term")
    return write_next_term(_next_term(spark, sf, FALL), terms, FALL, scratch_folder(spark, "next-term"))


@query(oracles.NEXT_ENROLMENT_AUDIT)
def next_term_enrolment_audit(spark, sf):
    return next_term_audit(_next_enrolments(spark, sf))


@query(oracles.UNMATCHED_CALENDARS)
def next_term_unmatched_calendar(spark, sf):
    rows = unmatched_calendars(source(spark, sf, "term_enrolment"), source(spark, sf, "academic_term"), QUARTER)
    return rows.select("ate_id", "academic_calendar_ate_c")


def _sentinels(df: DataFrame, column: str) -> DataFrame:
    counts = sentinel_counts(df, [column])
    return counts.select(F.lit(column).alias("checked"), F.col(f"n_{column}_sentinels").alias("n"))


@query(oracles.SENTINELS)
def sentinel_count(spark, sf):
    """Values that stand for a failed rule, by the column that holds them."""
    feed, records = source(spark, sf, "nsc_feed"), source(spark, sf, "student_term")
    majors = feed.select(classify(F.col("Degree_Major_1"), major_rules(any_multimedia=False)).alias("sfdc_major"))
    return (
        _sentinels(enrolled(feed), "Class")
        .union(_sentinels(majors, "sfdc_major"))
        .union(_sentinels(current_records(records), "school_calendar"))
    )


@query(oracles.activities("organization_c", "visit", "region_id", "TRUE"))
def region_visit_fanout(spark, sf):
    names = ["engagement", "contact", "visit"]
    return readiness_activities(*[source(spark, sf, name) for name in names])


@query(
    oracles.activities(
        "student_c",
        "schedule",
        "contact_id",
        "site_short IN ('San Francisco', 'East Palo Alto', 'Oakland')",
    )
)
def student_schedule(spark, sf):
    names = ["engagement", "contact", "schedule"]
    return readiness_activities(*[source(spark, sf, name) for name in names], by="student")


@query(oracles.NEW_APPLICATIONS)
def changed_rows_new_only(spark, sf):
    names = ["application_template", "school_account", "application_fact"]
    return new_applications(*[source(spark, sf, name) for name in names])


@query(oracles.ADMISSION_EDITS)
def admission_edit_rows(spark, sf):
    names = ["admission_template", "school_account"]
    return admission_edits(*[source(spark, sf, name) for name in names])


@query(oracles.AID_EDITS)
def aid_edit_rows(spark, sf):
    return aid_edits(source(spark, sf, "aid_template"))


@query(oracles.SUBMISSION)
def submission_file(spark, sf):
    records = submission_records(source(spark, sf, "contact"), SubmissionSpec(organisation="Some School"))
    return records.select("place", record_line().alias("line"))


@query(oracles.SUBMISSION)
def submission_written(spark, sf):
    """The written file, read back: its first line is the header, all others are details."""
    folder = scratch_folder(spark, "submission")
    write_submission(source(spark, sf, "contact"), folder, SubmissionSpec(organisation="Some School"))
    lines = read_positional(spark, folder)
    return lines.select(F.when(F.col("number") == 1, 0).otherwise(1).alias("place"), "line")


@query(oracles.TRACKED)
def track_edits_batch(spark, sf):
    return flags(track_edits(source(spark, sf, "edit_log"), EDITS))


@query(oracles.TRACKED)
def track_edits_stream(spark, sf):
    folder = scratch_folder(spark, "edits")
    log = f"{folder}/log"
    source(spark, sf, "edit_log").repartition(5, "seq").write.parquet(log)
    schema = source(spark, sf, "edit_log").schema
    edits = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(log)
    running = start_tracking(edits, folder, EDITS, available_now=True, compact_after=2)
    running.awaitTermination()
    remove(spark, log)
    remove(spark, f"{folder}/checkpoint")
    return flags(tracked_so_far(spark, folder))


@query(oracles.STAMPED)
def edits_to_template(spark, sf):
    template = source(spark, sf, "application_template").drop("EditTracker", "User")
    tracked = track_edits(source(spark, sf, "edit_log"), EDITS)
    rows = edited(stamp_template(template, tracked, "Applications"))
    return rows.select("row", "Full_Name", "EditTracker", "User")


@query(oracles.EDITED_APPLICATIONS)
def edits_to_applications(spark, sf):
    """From the log of edits over the template to the applications to create."""
    template = source(spark, sf, "application_template")
    tracked = track_edits(source(spark, sf, "edit_log"), EDITS)
    stamped = stamp_template(template, tracked, "Applications")
    return new_applications(stamped, source(spark, sf, "school_account"), source(spark, sf, "application_fact"))


@query(oracles.degrees(four_year=True, create=False))
def degree_4yr_update_from_csv(spark, sf):
    """The feed as a spreadsheet export, with flags as Y and N, gives what the table gives."""
    folder = scratch_folder(spark, "feed")
    feed = source(spark, sf, "nsc_feed").withColumns(
        {
            "Record_Found_Y_N": F.when(F.col("Record_Found_Y_N"), "Y").when(~F.col("Record_Found_Y_N"), "N"),
            "Graduated_": F.when(F.col("Graduated_"), "Yes").when(~F.col("Graduated_"), "No"),
        }
    )
    write_import(feed, folder, "csv", compression="lz4")
    others = [source(spark, sf, name) for name in ("student_term", "school_account", "scorecard", "term")]
    return degree_records(read_csv(spark, "nsc_feed", folder), *others, FOUR_YEAR_UPDATE)


def _feed_with_bad_dates(spark, sf, columns=None, keep=None):
    feed = source(spark, sf, "nsc_feed")
    text = feed.withColumn("Graduation_Date", F.expr(oracles.MALFORMED_DATE))
    return split_rows(text, "nsc_feed", ("Requester_Return_Field", "College_Code_Branch"), columns, keep)


@query(oracles.FEED_REJECTS)
def feed_rejects(spark, sf):
    """Cells of the feed that aren't of their column's type, or name no day."""
    return _feed_with_bad_dates(spark, sf).rejected


@query(oracles.degrees_of_good_rows())
def degree_4yr_update_tolerant(spark, sf):
    """Degrees of a feed with malformed dates: those of all its other rows."""
    feed = _feed_with_bad_dates(spark, sf, columns=("Graduation_Date",), keep=FEED_COLUMNS).good
    others = [source(spark, sf, name) for name in ("student_term", "school_account", "scorecard", "term")]
    return degree_records(feed, *others, FOUR_YEAR_UPDATE)
