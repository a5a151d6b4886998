"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """This application's folder below spark.checkpoint.dir; a temporary one where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own.setdefault("dir", tempfile.mkdtemp())
    return f"{base.rstrip('/')}/termweave-{spark.sparkContext.applicationId}"


_own: dict[str, str] = {}


def stage(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read again; their lineage is cut."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Deletes the files of staged tables that nothing reads any more."""
    spark = tables[0].sparkSession
    for path in {f.rpartition("/")[0] for df in tables for f in df.inputFiles()}:
        if f"/termweave-{spark.sparkContext.applicationId}/" in f"{path}/":
            _delete(spark, path)


def tidy(spark: SparkSession) -> None:
    """Lets Spark delete the files of finished shuffles that nothing on the driver refers to any more.

    It does so by itself when the driver collects its garbage, which may be long after the disks are full.
    """
    gc.collect()
    spark._jvm.System.gc()


def clear(spark: SparkSession) -> None:
    """Deletes all that this application staged."""
    _delete(spark, folder(spark))


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: Bytes of an Arrow batch: a JVM and a Python worker hold several at once for each core.
BATCH = 4 << 20


def ship(spark: SparkSession) -> None:
    """Readies a session: small Arrow batches, and this package's code on the executors.

    The code is sent once, as ``--py-files`` would.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    context = spark.sparkContext
    if _shipped.get("to") == context.applicationId:
        return
    package = Path(__file__).parents[1]
    archive = Path(tempfile.mkdtemp()) / "termweave_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped["to"] = context.applicationId


_shipped: dict[str, str] = {}
