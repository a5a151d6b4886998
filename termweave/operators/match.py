"""Feed rows against student-term records: which exist, which are missing."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matched_records(records: DataFrame, mapped: DataFrame) -> DataFrame:
    """Records of the student and term that a feed row was mapped to.

    Records carry ``contact_id_mod`` and ``PAT_GAS_id``, feed rows ``contact_id_nsc`` and
    ``GAS_id``.
    """
    return records.join(
        mapped,
        (records.contact_id_mod == mapped.contact_id_nsc) & (records.PAT_GAS_id == mapped.GAS_id),
    )


#: Parts that a student's feed rows of a term are gathered in.
PARTS = 32


def missing_records(students: DataFrame, mapped: DataFrame, records: DataFrame) -> DataFrame:
    """Distinct mapped feed rows of students none of whose feed rows has a record.

    ``students`` holds distinct student attributes with ``contact_id_mod``. One match excludes all
    of a student's degrees. Rows without a student or term match no record; a row without a student
    isn't missing one either.

    The feed is read once. Its distinct rows are gathered by student and term, those of a hot student
    in ``PARTS`` parts; numbers of feed rows and of records under a student and term then show the
    matches. Those aren't made distinct by student: the parts then meet them, and the students, in
    joins whose hot keys can be split, since both sides come straight out of a shuffle.
    """
    rest = [c for c in mapped.columns if c not in ("contact_id_nsc", "GAS_id")]
    part = F.pmod(F.xxhash64(*rest), F.lit(PARTS)) if rest else F.lit(0)
    gathered = (
        mapped.where(F.col("contact_id_nsc").isNotNull())
        .groupBy("contact_id_nsc", "GAS_id", part.alias("_part"))
        .agg(F.collect_set(F.struct(*rest, F.lit(1).alias("_one"))).alias("_rows"))
    )
    # The sizes keep the gathered rows in this branch too: both branches then share one shuffle.
    feed_side = gathered.select("contact_id_nsc", "GAS_id", F.size("_rows").alias("n_feed"), F.lit(0).alias("n_records"))
    record_side = records.select(
        F.col("contact_id_mod").alias("contact_id_nsc"), F.col("PAT_GAS_id").alias("GAS_id"), F.lit(0), F.lit(1)
    )
    found = feed_side.union(record_side).groupBy("contact_id_nsc", "GAS_id").agg(
        F.sum("n_feed").alias("n_feed"), F.sum("n_records").alias("n_records")
    )
    match = F.col("GAS_id").isNotNull() & (F.col("n_feed") > 0) & (F.col("n_records") > 0)
    matched = found.where(match).select(F.col("contact_id_nsc").alias("matched_id"))
    unmatched = gathered.join(matched, F.col("contact_id_nsc") == F.col("matched_id"), "left_anti")
    return students.join(unmatched, F.col("contact_id_mod") == F.col("contact_id_nsc")).select(
        *students.columns,
        "contact_id_nsc",
        "GAS_id",
        F.explode("_rows").alias("_row"),
    ).select(*students.columns, *[F.col(c if c in ("contact_id_nsc", "GAS_id") else f"_row.{c}").alias(c) for c in mapped.columns])
