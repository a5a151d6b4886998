"""Edit flags of spreadsheet rows, from a log of cell edits."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termweave.sources.schemas import SCHEMAS


@dataclass(frozen=True)
class EditSpec:
    """Whose edits do not count, and on which sheets a user column exists."""

    maintainers: tuple[str, ...] = ()
    ignored_sheet: str = "READ"
    sheets_without_user: tuple[str, ...] = ()
    header_row: int = 1


def _blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def _is_tracked(spec: EditSpec) -> Column:
    old, new = F.col("old_value"), F.col("new_value")
    changed = ~_blank(new) & ~old.eqNullSafe(new)
    cleared = _blank(new) & ~_blank(old)
    by_staff = ~F.coalesce(F.col("user").isin(*spec.maintainers), F.lit(False))
    return (F.col("sheet") != spec.ignored_sheet) & by_staff & (changed | cleared)


def track_edits(edit_log: DataFrame, spec: EditSpec = EditSpec()) -> DataFrame:
    """Edited rows per sheet with their flag and the user of the last edit.

    Works on a batch and on a stream (update mode). The user is stamped where a user column exists and
    never on the header row. The last edit is found by time and then sequence, so the order
    in which the log arrives does not matter; the state is one user per edited row.
    """
    stamped = (F.col("row") > spec.header_row) & ~F.col("sheet").isin(*spec.sheets_without_user)
    last = F.when(stamped, F.struct("ts", "seq"))
    return (
        edit_log.where(_is_tracked(spec))
        .groupBy("sheet", "row")
        .agg(
            F.lit("1").alias("EditTracker"),
            F.max(last).alias("last_edit"),
            F.max_by("user", last).alias("User"),
        )
    )


def flags(tracked: DataFrame) -> DataFrame:
    """The columns that go back into the sheet."""
    return tracked.select("sheet", "row", "EditTracker", "User")


def stamp_template(template: DataFrame, tracked: DataFrame, sheet: str) -> DataFrame:
    """A template snapshot (with its ``row`` numbers) with the flags of its edited rows."""
    marks = tracked.where(F.col("sheet") == sheet).select(
        F.col("row").alias("marked_row"),
        F.col("EditTracker").cast("int").alias("mark"),
        F.col("User").alias("mark_user"),
    )
    kept = template
    for column, kind in (("EditTracker", "int"), ("User", "string")):
        if column not in template.columns:
            kept = kept.withColumn(column, F.lit(None).cast(kind))
    return (
        kept.join(marks, F.col("row") == F.col("marked_row"), "left")
        .withColumns(
            {
                "EditTracker": F.coalesce("mark", "EditTracker"),
                "User": F.coalesce("mark_user", "User"),
            }
        )
        .drop("marked_row", "mark", "mark_user")
    )


def read_edit_stream(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """A folder of parquet files with edits, as a stream."""
    reader = spark.readStream.schema(SCHEMAS["edit_log"])
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


#: Micro-batches whose changes are kept apart before they are merged into one snapshot.
COMPACT_AFTER = 10


def _files(spark: SparkSession, folder: str):
    """A folder below the states, and the file system that it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    place, files = _files(spark, folder)
    return [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []


def _number(name: str) -> int:
    """The micro-batch that ``batch=<number>`` or ``snapshot=<number>`` ends with."""
    return int(name.partition("=")[2])


def _version(spark: SparkSession, folder: str) -> tuple[int, list[str]]:
    """Number of the last complete version, and the datasets that it consists of; -1 before the first."""
    number = max((int(name) for name in _names(spark, f"{folder}/versions") if name.isdigit()), default=-1)
    if number < 0:
        return number, []
    return number, [row.value for row in spark.read.text(f"{folder}/versions/{number}").collect()]


def _publish(spark: SparkSession, folder: str, number: int, datasets: list[str]) -> None:
    """Makes the datasets the version of a micro-batch: a file of their names, in place by a rename."""
    draft, files = _files(spark, f"{folder}/versions/_{number}")
    out = files.create(draft, True)
    out.write(bytearray("\n".join(datasets).encode()))
    out.close()
    place, _ = _files(spark, f"{folder}/versions/{number}")
    if not files.rename(draft, place):
        raise OSError(f"version {number} could not be put in place")


def _retire(spark: SparkSession, folder: str, before: int) -> None:
    """Deletes what only versions older than the snapshot of micro-batch ``before`` are made of."""
    old = [name for name in _names(spark, folder) if name.startswith("snapshot=") and _number(name) < before]
    old += [name for name in _names(spark, folder) if name.startswith("batch=") and _number(name) <= before]
    old += [f"versions/{name}" for name in _names(spark, f"{folder}/versions") if name.isdigit() and int(name) < before]
    for name in old:
        place, files = _files(spark, f"{folder}/{name}")
        files.delete(place, True)


def _latest(spark: SparkSession, folder: str, datasets: list[str]) -> DataFrame:
    """The last state of each row among the datasets of a version."""
    parts = [
        spark.read.schema(_STATE).parquet(f"{folder}/{name}").withColumn("n", F.lit(_number(name)))
        for name in datasets
    ]
    state = F.struct("EditTracker", "last_edit", "User")
    return (
        reduce(DataFrame.union, parts)
        .groupBy("sheet", "row")
        .agg(F.max_by(state, "n").alias("state"))
        .select("sheet", "row", "state.*")
    )


_STATE = T.StructType(
    [
        T.StructField("sheet", T.StringType()),
        T.StructField("row", T.IntegerType()),
        T.StructField("EditTracker", T.StringType()),
        T.StructField(
            "last_edit", T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("seq", T.LongType())])
        ),
        T.StructField("User", T.StringType()),
    ]
)


def _write_batch(folder: str, compact_after: int):
    states = f"{folder}/states"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        number, datasets = _version(spark, states)
        if batch_id <= number:
            return  # it comes again, and its version is complete: readers may be at its files
        # What no version names yet is nobody's: a batch that failed half-way writes it anew.
        batch.write.mode("overwrite").parquet(f"{states}/batch={batch_id}")
        datasets = [*datasets, f"batch={batch_id}"]
        if sum(name.startswith("batch=") for name in datasets) < compact_after:
            _publish(spark, states, batch_id, datasets)
            return
        merged = f"snapshot={batch_id}"
        _latest(spark, states, datasets).write.mode("overwrite").parquet(f"{states}/{merged}")
        _publish(spark, states, batch_id, [merged])
        # What this snapshot replaces stays until the next one: for as long, readers can be at it.
        for name in datasets:
            if name.startswith("snapshot="):
                _retire(spark, states, _number(name))

    return write


def start_tracking(
    edits: DataFrame,
    folder: str,
    spec: EditSpec = EditSpec(),
    available_now: bool = False,
    compact_after: int = COMPACT_AFTER,
):
    """A streaming query that keeps the state of each edited row below ``folder``.

    The folder must be one that all executors share; states and checkpoint in it belong together. It
    holds versions: files that name the datasets which are the state after a micro-batch. Changes of
    ``compact_after`` micro-batches are merged into a snapshot; what a snapshot replaces goes with the
    next one. So there are two snapshots and the changes of two cycles at most, as much as there are
    edited rows, however long the stream runs.
    """
    writer = (
        track_edits(edits, spec)
        .writeStream.outputMode("update")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .foreachBatch(_write_batch(folder, compact_after))
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def tracked_so_far(spark: SparkSession, folder: str) -> DataFrame:
    """The latest state of each edited row in the folder of a tracking query; none before the first.

    It is the state of one complete version, whatever is written while it is read: the version's
    files outlast the snapshot that replaces them, until the snapshot after that.
    """
    _, datasets = _version(spark, f"{folder}/states")
    if not datasets:
        return spark.createDataFrame([], _STATE)
    return _latest(spark, f"{folder}/states", datasets)
