"""Named sources, read with a pinned schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termweave.functions.dates import or_raise
from termweave.sources.columns import STUDENT_KEY
from termweave.sources.schemas import SCHEMAS


class MissingColumns(ValueError):
    """A source lacks columns that its schema names."""


def require_columns(df: DataFrame, source: str) -> None:
    """Fails if a column of the source's schema is missing."""
    present = {name.lower() for name in df.columns}
    missing = [field.name for field in SCHEMAS[source] if field.name.lower() not in present]
    if missing:
        raise MissingColumns(f"{source}: {', '.join(missing)}")


def conform(df: DataFrame, source: str) -> DataFrame:
    """The columns of a source in schema order and type; fails if one is missing.

    A value that isn't of its column's type raises, whatever the session's ANSI mode. Text of
    flags may be ``Y``, ``Yes``, ``True`` or ``1``, their opposites, in either case, or blank. The key
    of a table that is laid out by student stays behind them.
    """
    require_columns(df, source)
    kinds = {f.name.lower(): f.dataType for f in df.schema}
    layout = [STUDENT_KEY] if STUDENT_KEY in df.columns else []
    return df.select([typed_value(f, kinds[f.name.lower()]) for f in SCHEMAS[source]] + layout)


def present_value(field: T.StructField, given: T.DataType, cell: Column | None = None) -> Column:
    """A column's value; text of other than text columns trimmed, blank text as NULL."""
    value = F.col(f"`{field.name}`") if cell is None else cell
    if isinstance(given, T.StringType) and not isinstance(field.dataType, T.StringType):
        value = F.when(F.trim(value) != "", F.trim(value))
    return value


def typed_value(field: T.StructField, given: T.DataType) -> Column:
    """A column as its schema has it; a value of another type raises."""
    value = present_value(field, given)
    if given == field.dataType or isinstance(field.dataType, T.StringType):
        return value.cast(field.dataType).alias(field.name)
    kind = field.dataType.simpleString()
    return or_raise(value.try_cast(kind), value, kind).alias(field.name)


def read_parquet(spark: SparkSession, source: str, path: str) -> DataFrame:
    return conform(spark.read.parquet(path), source)


def read_csv_text(
    spark: SparkSession, source: str, path: str, line_breaks: bool = False
) -> DataFrame:
    """A spreadsheet export as text cells. The header must name the schema's columns in order.

    ``line_breaks`` allows them within cells; a file is then read by one task. Without it
    such a cell fails the read.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in SCHEMAS[source]])
    return (
        spark.read.schema(text)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("multiLine", line_breaks)
        .csv(path)
    )


def read_csv(
    spark: SparkSession, source: str, path: str, line_breaks: bool = False
) -> DataFrame:
    """A spreadsheet export, read by ``read_csv_text`` and typed as ``conform`` does."""
    return conform(read_csv_text(spark, source, path, line_breaks), source)


def read_table(spark: SparkSession, source: str, table: str) -> DataFrame:
    return conform(spark.table(table), source)


class Sources:
    """Lookup of DataFrames by source name."""

    def __init__(self, frames: dict[str, DataFrame] | None = None):
        self._frames: dict[str, DataFrame] = {}
        for source, df in (frames or {}).items():
            self.add(source, df)

    def add(self, source: str, df: DataFrame) -> Sources:
        self._frames[source] = conform(df, source)
        return self

    def __getitem__(self, source: str) -> DataFrame:
        return self._frames[source]

    @classmethod
    def from_directory(cls, spark: SparkSession, directory: str, names: list[str]) -> Sources:
        """One parquet dataset per source under one directory."""
        return cls({n: read_parquet(spark, n, f"{directory}/{n}.parquet") for n in names})

    @classmethod
    def from_tables(cls, spark: SparkSession, tables: dict[str, str]) -> Sources:
        """Catalog tables by source name."""
        return cls({source: read_table(spark, source, t) for source, t in tables.items()})
