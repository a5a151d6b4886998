"""Decoding of code books and normalising of picklists."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Enrolment status codes of the feed.
FULL_TIME, PART_TIME = "Full-time", "Part-time"
FULL_TIME_CODES = ["F"]
PART_TIME_CODES = ["Q", "H", "L"]
ENROLLED_CODES = FULL_TIME_CODES + PART_TIME_CODES
STATUS_ERROR = "Error or Not Enrolled"

# Class level codes of the feed.
CLASS_LEVELS = [
    ("Undergraduate", ["F", "S", "J", "R", "C", "N", "B"]),
    ("Associate's", ["A"]),
    ("Graduate", ["M", "D", "P", "L"]),
    ("Graduate or Professional", ["G"]),
    ("Graduate or Post-Bacc", ["T"]),
]
CLASS_ERROR = "Error"

# Kinds of degree and of school.
CERTIFICATE, TWO_YEAR, FOUR_YEAR = "Certificate", "2-year degree", "4-year degree"
SCHOOL_TYPES = [
    "Predominantly bachelor's-degree granting",
    "Predominantly associate's-degree granting",
]

# Fixed value: calendar of a record whose name gives none.
CALENDAR_ERROR = "Check"


def decode_status(c: Column) -> Column:
    return (
        F.when(c.isin(FULL_TIME_CODES), FULL_TIME)
        .when(c.isin(PART_TIME_CODES), PART_TIME)
        .otherwise(STATUS_ERROR)
    )


def decode_class(c: Column) -> Column:
    (label, codes), *rest = CLASS_LEVELS
    decoded = F.when(c.isin(codes), label)
    for label, codes in rest:
        decoded = decoded.when(c.isin(codes), label)
    return decoded.otherwise(CLASS_ERROR)


def normalise_calendar(c: Column) -> Column:
    """Trimester colleges follow the semester calendar."""
    return F.when(c == "Trimester", "Semester").otherwise(c)


def calendar_of_name(c: Column) -> Column:
    """Calendar that a record's name carries in brackets."""
    return (
        F.when(c.contains("(Semester)"), "Semester")
        .when(c.contains("(Quarter)"), "Quarter")
        .otherwise(CALENDAR_ERROR)
    )


def degree_kind(title: Column) -> Column:
    return F.when(title.contains("CERTIF"), CERTIFICATE).otherwise(TWO_YEAR)


def school_type_rank(c: Column) -> Column:
    """1 for bachelor's, 2 for associate's granting schools, 3 for all others."""
    return F.when(c == SCHOOL_TYPES[0], 1).when(c == SCHOOL_TYPES[1], 2).otherwise(3)


def is_true(c: Column) -> Column:
    return c.eqNullSafe(True)
