"""Cleaning of the ids that join the external feed to the CRM."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_return_key(c: Column) -> Column:
    """The id a feed row returns, without its underscores. The case is kept."""
    return F.replace(c, F.lit("_"), F.lit(""))


def match_key(c: Column) -> Column:
    """The CRM id in the upper case that feed ids carry."""
    return F.upper(c)


def first_word(c: Column) -> Column:
    """Text before the first blank; all of it when there is none."""
    return F.substring_index(c, " ", 1)


def branch_code(c: Column) -> Column:
    """College code before the dash, without leading zeros (``'00000000-00'`` gives ``''``)."""
    return F.ltrim(F.substring_index(c, "-", 1), F.lit("0"))


def first_token(c: Column, sep: str = "|") -> Column:
    """First element of a separated list."""
    return F.substring_index(c, sep, 1)
