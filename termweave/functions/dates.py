"""Dates that travel as numbers or text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_yyyymmdd(c: Column) -> Column:
    """A ``YYYYMMDD`` number as a date. Malformed input raises, whatever the session's ANSI mode.

    Arithmetic in place of a text parser, which costs most of a scan of the feed. Numbers of
    another length get month 0, which is no date.
    """
    number = c.try_cast("bigint")
    month = F.floor(number / 100) % 100
    eight_digits = number.isNull() | number.between(10000101, 99991231)
    date = F.make_date(
        F.floor(number / 10000).cast("int"),
        F.when(eight_digits, month).otherwise(0).cast("int"),
        (number % 100).cast("int"),
    )
    return or_raise(date, c, "date")


def try_yyyymmdd(c: Column) -> Column:
    """A ``YYYYMMDD`` number or text as a date; NULL where it names no day, whatever the session's ANSI mode."""
    text = c.cast("string")
    return F.when(F.length(text) == 8, F.try_to_date(text, "yyyyMMdd"))


def or_raise(result: Column, given: Column, kind: str) -> Column:
    """The result, of the Spark type ``kind``; an error where it is NULL though a value was given.

    Outside ANSI mode what can't be cast becomes NULL, and its row would drop out of joins unseen.
    """
    error = F.raise_error(F.concat(F.lit(f"not a {kind}: "), given.cast("string")))
    return F.when(given.isNotNull(), F.coalesce(result, error.cast(kind)))


def span_label(begin: Column, end: Column) -> Column:
    """``2022-08-22 to 2022-12-16``; NULL when either date is NULL."""
    return F.concat(begin.cast("string"), F.lit(" to "), end.cast("string"))


def compact_date(c: Column) -> Column:
    """A date, or ISO text of one, as eight digits."""
    return F.lpad(F.date_format(c.cast("date"), "yyyyMMdd"), 8, "0")


def search_date(hs_class: Column) -> Column:
    """First of June of the graduating class as a number, e.g. 20140601."""
    return F.concat(hs_class.cast("string"), F.lit("0601")).cast("int")
