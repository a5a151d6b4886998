"""Fields that a new term takes over from the current one, or not."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_when(c: Column, condition: Column) -> Column:
    """NULL where the condition holds, else the value, also where the condition is NULL."""
    return F.when(condition, None).otherwise(c)


def filled_when(c: Column, condition: Column, fallback: Column) -> Column:
    """The fallback in place of a missing value, only where the condition holds."""
    return F.when(condition & c.isNull(), fallback).otherwise(c)
