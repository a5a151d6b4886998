"""Renaming to the field names of an import file."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def import_fields(df: DataFrame, mapping: list[tuple[str, str | Column]]) -> DataFrame:
    """Columns in import order: ``(import name, source column or expression)``."""
    return df.select(
        [(F.col(src) if isinstance(src, str) else src).alias(name) for name, src in mapping]
    )
