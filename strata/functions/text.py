"""String rules for customer names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same results:
# the character class removed from names, and the pattern a clean name matches.
NON_LETTERS_PATTERN = "[^A-Za-z]"
LETTERS_ONLY_PATTERN = "^[A-Za-z]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_non_letters(c: Column | str) -> Column:
    """Remove every character outside A-Z / a-z; null stays null.

    "Mary O'Brien 3" -> "MaryOBrien"; accented letters are removed too.
    """
    return F.regexp_replace(_col(c), NON_LETTERS_PATTERN, "")


def email_local_part(c: Column | str) -> Column:
    """Text before the first '@' (the whole string when there is none)."""
    return F.substring_index(_col(c), "@", 1)


def is_not_letters_only(c: Column | str) -> Column:
    """True for a non-null value that is not one or more ASCII letters.

    Null yields null, so a filter on it keeps neither null nor clean rows;
    the empty string is a violation.
    """
    return ~_col(c).rlike(LETTERS_ONLY_PATTERN)
