"""Cleaning of person names for the submission file.

Patterns spell out the Unicode classes, because Java's ``\\w`` and ``\\s`` are ASCII and
would strip the accent off a name.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_LETTER = r"\p{L}\p{Nl}\p{No}_"
_WORD = r"\p{L}\p{N}_"
_SPACE = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"

# Fixed value: endings of a last name that are a suffix (no word boundary before them,
# and the dot after Jr is any character).
SUFFIX = r"((Jr|Jr.|I{1,3}|IV|V|VI|VII|VIII|IX)$)"

DOTTED_INITIAL = rf"([{_WORD}]\.)"
NOT_LETTER = rf"[^{_LETTER}]+"
NOT_NAME = rf"[^{_WORD}{_SPACE}-]"


def _remove(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, pattern, "")


def _non_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def name_suffix(last_name: Column) -> Column:
    """Jr or a Roman numeral at the end of a last name, letters only; NULL if there is none."""
    found = F.regexp_extract(last_name, SUFFIX, 1)
    return F.when(found != "", _remove(found, NOT_LETTER))


def without_suffix(last_name: Column) -> Column:
    """The last name with its suffix cut off; blanks before the suffix stay."""
    return _remove(last_name, SUFFIX)


def middle_initial(first_name: Column, middle_name: Column) -> Column:
    """Upper-case initial: a dotted one in the first name, else the middle name's."""
    dotted = _non_empty(F.regexp_extract(first_name, DOTTED_INITIAL, 1))
    middle = _non_empty(_remove(middle_name, NOT_LETTER))
    return F.upper(F.substring(F.coalesce(dotted, middle), 1, 1))


def without_initials(first_name: Column) -> Column:
    return _remove(first_name, DOTTED_INITIAL)


def plain_name(c: Column) -> Column:
    """Apostrophes become blanks; all else but letters, digits, blanks and hyphens goes."""
    return _remove(F.replace(c, F.lit("'"), F.lit(" ")), NOT_NAME)
