"""Tolerant reading: rows that a source's schema can't take go to a table of their own.

The strict readers of ``registry`` end a job at the first malformed value. Here a source is split
into rows that are typed like its schema and rejects, one for each malformed cell, with the column,
the text that was found and what is wrong with it. Nothing is lost: a row is in one of the two.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termweave.functions.dates import try_yyyymmdd
from termweave.sources.registry import present_value, require_columns, typed_value
from termweave.sources.schemas import DATE_NUMBERS, SCHEMAS

NOT_A_DATE = "not a date"


@dataclass(frozen=True)
class Split:
    """``good`` has the source's columns and types, or those of them to keep; ``rejected`` the columns that ``split_rows`` names."""

    good: DataFrame
    rejected: DataFrame


def _problem(
    field: T.StructField, given: T.DataType, dates: tuple[str, ...], cell: Column | None = None
) -> Column | None:
    """What is wrong with a cell; NULL where nothing is, as with blank cells. None if nothing can be."""
    value = present_value(field, given, cell)
    kind = field.dataType.simpleString()
    typed = given == field.dataType or isinstance(field.dataType, T.StringType)
    if typed and field.name not in dates:
        return None
    cast = value.try_cast(kind)
    bad = F.lit(False) if typed else cast.isNull()
    out = F.when(bad, F.lit(f"not a {kind}"))
    if field.name in dates:
        out = out.when(try_yyyymmdd(cast).isNull(), F.lit(NOT_A_DATE))
    return F.when(value.isNotNull(), out)


def split_rows(
    df: DataFrame,
    source: str,
    keys: tuple[str, ...] = (),
    columns: tuple[str, ...] | None = None,
    keep: tuple[str, ...] | None = None,
) -> Split:
    """The rows of a source that its schema can take, and the cells that it can't.

    A cell is malformed if its text isn't of its column's type, or if it is in one of the source's
    ``YYYYMMDD`` columns and names no day. ``columns`` limits the check to what a product reads; in
    others the strict rule holds. ``keep`` limits the good rows to the columns that a product reads, which
    Spark can't tell by itself behind the count of rows. Rejects have the ``keys``, by which a row is found again,
    ``column``, ``found`` and ``problem``.
    """
    require_columns(df, source)
    schema = SCHEMAS[source]
    kinds = {f.name.lower(): f.dataType for f in df.schema}
    dates = DATE_NUMBERS.get(source, ())
    problems = {
        f.name: _problem(f, kinds[f.name.lower()], dates) for f in schema if columns is None or f.name in columns
    }
    checks = {name: problem for name, problem in problems.items() if problem is not None}
    cells = [
        F.when(
            problem.isNotNull(),
            F.struct(F.lit(name).alias("column"), F.col(f"`{name}`").cast("string").alias("found"), problem.alias("problem")),
        )
        for name, problem in checks.items()
    ]

    # Pushed below the expressions that make the columns, a condition would work a cell out wherever it
    # names it. A variable holds it once.
    def is_fine(name: str) -> Column:
        return F.forall(
            F.array(F.col(f"`{name}`")), lambda cell: _problem(schema[name], kinds[name.lower()], dates, cell).isNull()
        )

    fine = reduce(and_, map(is_fine, checks), F.lit(True))
    return Split(
        # The count is a border that no condition of a product is pushed through, as it might be
        # evaluated on rows that are left out. A listener can read it by its name.
        good=df.where(fine)
        .select([typed_value(f, kinds[f.name.lower()]) for f in schema if keep is None or f.name in keep])
        .observe(f"{source} rows kept", F.count(F.lit(1)).alias("n_rows")),
        rejected=df.select(*keys, F.explode(F.array_compact(F.array(*cells))).alias("_cell")).select(
            *keys, "_cell.column", "_cell.found", "_cell.problem"
        ),
    )
