"""Counts that show whether a product is plausible."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termweave.functions.codes import CALENDAR_ERROR, CLASS_ERROR, STATUS_ERROR
from termweave.functions.degrees import MAJOR_ERROR

SENTINELS = [MAJOR_ERROR, CLASS_ERROR, STATUS_ERROR, CALENDAR_ERROR]


def record_count_audit(df: DataFrame, term_col: str, id_col: str) -> DataFrame:
    """Students and records per target term."""
    return df.groupBy(term_col).agg(
        F.count(id_col).alias("n_students"), F.count(F.lit(1)).alias("n_records")
    )


def sentinel_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: per column the number of values that stand for a failed rule."""
    return df.agg(*[value.alias(name) for name, value in sentinel_count_columns(columns).items()])



def term_counts(term_col: str, id_col: str, terms: list[str]) -> dict[str, Column]:
    """Aggregates of ``record_count_audit`` for terms known before, and for all others together.

    For ``write_import``, which can take them while it writes.
    """
    term = F.col(term_col)
    known = {f"{k}": term == F.lit(name) for k, name in enumerate(terms)}
    known["other"] = ~F.coalesce(term.isin(terms), F.lit(False)) if terms else F.lit(True)
    out = {}
    for k, here in known.items():
        out[f"n_students_{k}"] = F.count_if(here & F.col(id_col).isNotNull())
        out[f"n_records_{k}"] = F.count_if(here)
    return out


def term_count_rows(
    spark: SparkSession, seen: dict[str, int], term_col: str, terms: list[str]
) -> DataFrame:
    """Observed ``term_counts`` as the rows of ``record_count_audit``; a NULL term is any other one."""
    named = [*((name, str(k)) for k, name in enumerate(terms)), (None, "other")]
    rows = [(name, seen[f"n_students_{k}"], seen[f"n_records_{k}"]) for name, k in named]
    return spark.createDataFrame(
        [r for r in rows if r[2]], f"`{term_col}` string, n_students bigint, n_records bigint"
    )


def sentinel_count_columns(columns: list[str]) -> dict[str, Column]:
    """Aggregates of ``sentinel_counts``, for ``write_import``."""
    return {f"n_{c}_sentinels": F.count_if(F.col(c).isin(SENTINELS)) for c in columns}
