"""Where import rows go."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


#: Rows of a compressed part, which is read by one task.
PART_ROWS = 1_000_000


def write_import(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    counts: dict[str, Column] | None = None,
    compression: str | None = None,
) -> dict[str, int]:
    """Import rows as parquet, or as CSV parts with a header line each.

    ``counts`` are aggregates, by name, that are taken of the rows as they are written: the product
    runs once for the import and its audit. They are observed in the tasks that write, so a task
    that is tried again counts once. Returns their values. ``compression`` is for exports that Spark
    reads again: ``lz4`` takes a third of the disk for little time; no part then has more than ``PART_ROWS`` rows.
    """
    seen = Observation() if counts else None
    if seen:
        df = df.observe(seen, *[value.alias(name) for name, value in counts.items()])
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.options(header=True, **_PLAIN_CSV)
    if compression:
        writer = writer.options(compression=compression, maxRecordsPerFile=PART_ROWS)
    writer.format(fmt).save(path)
    return seen.get if seen else {}


# Blank fields stay blank, blanks at the ends of names stay, and quotes are doubled.
_PLAIN_CSV = {
    "nullValue": "",
    "emptyValue": "",
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_positional(df: DataFrame, path: str) -> None:
    """Rows by position without column names.

    Part files are numbered in the order of the DataFrame's partitions, so a record in the
    first partition opens the first part, and the parts in name order are the whole file.
    """
    df.write.mode("overwrite").options(header=False, **_PLAIN_CSV).csv(path)


def read_positional(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a file that ``write_positional`` wrote as parts, with their ``number`` from 1.

    Lines are numbered within their part, by the order of its splits and then of their lines, and
    parts in name order. A window holds one part, which one task wrote; the parts' offsets are one
    row each.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_name").alias("part"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    inside = lines.withColumn("row", F.row_number().over(Window.partitionBy("part").orderBy("block", "place")))
    sizes = inside.groupBy("part").agg(F.max("row").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("part").alias("offset_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return inside.join(offsets, F.col("part") == F.col("offset_part")).select(
        (F.col("offset") + F.col("row")).alias("number"), "line"
    )


def line_differences(expected: DataFrame, path: str) -> DataFrame:
    """Lines that a written file has more or less often than ``expected`` (``line``) has them.

    ``n_expected`` and ``n_written`` tell how often; no row means that the file holds what was to be
    written, each line as often as it should. Lines are counted on either side before they meet, so
    one that is very frequent is a row.
    """
    written = expected.sparkSession.read.text(path).select(F.col("value").alias("line"), F.lit(0).alias("e"), F.lit(1).alias("w"))
    both = expected.select("line", F.lit(1).alias("e"), F.lit(0).alias("w")).union(written)
    counts = both.groupBy("line").agg(F.sum("e").alias("n_expected"), F.sum("w").alias("n_written"))
    return counts.where(F.col("n_expected") != F.col("n_written"))
