"""Session settings the plans count on."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split the hot keys of a join even if the rows must then be shuffled again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows of a few hundred bytes are sorted and made distinct in several times their shuffled size. A
    # shuffle has many partitions, and neighbours are joined up to this size only, so that a task's
    # memory doesn't grow with the input.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    # The JVM never compiles methods beyond this size, which wide rows and long rule lists
    # reach in whole-stage code; they run faster as several small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

#: For sessions whose tables are laid out by student: a join on student and term is content with
#: rows that lie together by student alone.
BY_STUDENT = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def tune(spark: SparkSession, by_student: bool = False) -> SparkSession:
    """Sets what the plans count on.

    ``by_student`` is for tables that ``layout.write_by_student`` wrote. Don't set it with others:
    their joins by student and term are shuffled anyway, and by both a hot student spreads better.
    """
    for name, value in (SETTINGS | (BY_STUDENT if by_student else {})).items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def within(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for what is made and run within it."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
