"""Feed and student records laid out by student, so that products meet them without a shuffle.

A table in buckets of the student's key carries that key as a column of its own, since buckets
show in a plan only where the join's key is the column itself. ``Sources`` keeps the column and the
products take it where it is; without it they work the key out of the row.
"""

from __future__ import annotations

from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.functions.keys import clean_return_key, match_key
from termweave.session import within
from termweave.sources.columns import STUDENT_KEY, STUDENT_PART
from termweave.sources.registry import conform

#: Rows of one student up to which a table is laid out by student: they are read by one task.
MOST_ROWS = 1_000_000

#: Rows of a bucket that ``buckets_for`` aims at: a bucket is written and read by one task.
BUCKET_ROWS = 500_000

#: Parts that a table is staged in: a task writes a file for each.
PARTS = 24

#: Rows that a task aims at which puts staged rows into buckets.
TASK_ROWS = 250_000

#: For the queries that copy a table. None of their DataFrames runs twice, which would make shuffles anew.
COPYING = {
    # Shuffle files go when a query ends. Otherwise they stay until the driver's JVM happens to collect its plan.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # A task sorts rows by part that may be many times as wide as what it read of a shuffle.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8MB",
    # A union of sets of one task each has a task for each set.
    "spark.sql.unionOutputPartitioning": "false",
}

_DERIVED = {
    "nsc_feed": lambda: clean_return_key(F.col("Requester_Return_Field")),
    "student_term": lambda: match_key(F.col("Contact_Id")),
}


def student_key(df: DataFrame, source: str) -> Column:
    """The key that the feed and the student records have in common."""
    return F.col(STUDENT_KEY) if STUDENT_KEY in df.columns else _DERIVED[source]()


def counts_by_student(df: DataFrame, source: str) -> tuple[int, int]:
    """Rows of a table, and of the student with the most of them; those without a student count as one."""
    counts = df.groupBy(student_key(df, source).alias("k")).count()
    with within(df.sparkSession, COPYING):
        rows, most = counts.agg(F.sum("count"), F.max("count")).first()
    return rows or 0, most or 0


def most_rows_of_a_student(df: DataFrame, source: str) -> int:
    """Rows of the student with the most of them; those without a student count as one."""
    return counts_by_student(df, source)[1]


def buckets_for(rows: int, least: int = 8) -> int:
    """Buckets for tables of which the largest has so many rows: a task's share doesn't grow with them.

    More than ``PARTS`` are a multiple of it, so that a part of a staged table has buckets of its own.
    """
    needed = max(least, -(-rows // BUCKET_ROWS))
    return needed if needed <= PARTS else -(-needed // PARTS) * PARTS


def stage_by_student(df: DataFrame, source: str, path: str) -> DataFrame:
    """A source written once, whole, in ``PARTS`` parts by student, to be counted and laid out from there.

    What the source is made of runs once, and its shuffles are gone when it is written. Nothing is
    shuffled for the parts: a task writes what it has of each, and columns in compressed files take a
    fraction of the rows' size in a shuffle. The caller removes the folder after ``write_by_student``.
    """
    rows = conform(df.drop(STUDENT_KEY), source)
    keyed = rows.withColumn(STUDENT_KEY, student_key(rows, source))
    staged = keyed.withColumn(STUDENT_PART, F.pmod(F.hash(STUDENT_KEY), F.lit(PARTS)))
    with within(df.sparkSession, COPYING):
        staged.write.partitionBy(STUDENT_PART).parquet(path, compression="zstd")
    return df.sparkSession.read.schema(staged.schema).parquet(path)


def write_by_student(
    df: DataFrame,
    source: str,
    table: str,
    buckets: int,
    path: str | None = None,
    most: int = MOST_ROWS,
    hottest: int | None = None,
) -> bool:
    """Writes a source as a catalog table in ``buckets`` buckets by student, sorted within their files.

    Tables that are to be joined need the same number of buckets, which ``buckets_for`` gives. A join of bucketed tables can't be
    split, so a table with a student of more than ``most`` rows is written without buckets: it is then
    shuffled when it is joined, where its hot student is split. Returns whether it has buckets. The
    table is written whole either way, below ``path`` if one is given. ``hottest`` is that student's number
    of rows, where it is known from ``counts_by_student``; it is counted otherwise.

    Rows are shuffled into a file for each bucket. Those of ``stage_by_student`` aren't: a task writes
    what it has of each bucket, and as it reads some parts only, it has few buckets.
    """
    staged = STUDENT_PART in df.columns
    rows = conform(df if staged else df.drop(STUDENT_KEY), source)
    in_buckets = (most_rows_of_a_student(rows, source) if hottest is None else hottest) <= most
    with within(df.sparkSession, COPYING):
        if not in_buckets:
            writer = rows.drop(STUDENT_KEY).write
        else:
            if staged:
                rows = conform(_by_buckets(df, buckets), source)
            else:
                # A bucket is written by one task, so it is one file.
                rows = rows.withColumn(STUDENT_KEY, student_key(rows, source)).repartition(buckets, STUDENT_KEY)
            writer = rows.write.bucketBy(buckets, STUDENT_KEY).sortBy(STUDENT_KEY)
        if path:
            writer = writer.option("path", path)
        writer.format("parquet").mode("overwrite").saveAsTable(table)
    return in_buckets


def _by_buckets(staged: DataFrame, buckets: int) -> DataFrame:
    """Staged rows in tasks of ``TASK_ROWS`` or so, each of parts that share buckets with no others."""
    sets = gcd(PARTS, buckets)
    own = F.col(STUDENT_PART) % sets
    sizes = dict(staged.groupBy(own).count().collect())
    tasks = {n: staged.where(own == n).coalesce(-(-rows // TASK_ROWS)) for n, rows in sorted(sizes.items())}
    return reduce(DataFrame.union, tasks.values(), staged.limit(0))


def read_by_student(spark: SparkSession, source: str, table: str) -> DataFrame:
    """A table that ``write_by_student`` wrote, with its key if it has buckets."""
    return conform(spark.table(table), source)
