"""Column expressions (all built-in, JVM-side, codegen-friendly)."""

from strata.functions.dates import DAY_FIRST_FORMATS, parse_day_first_date, year_of
from strata.functions.money import MONEY_TYPE, has_more_than_2_decimals, round_money
from strata.functions.text import (
    LETTERS_ONLY_PATTERN,
    email_local_part,
    is_not_letters_only,
    strip_non_letters,
)

__all__ = [
    "DAY_FIRST_FORMATS",
    "LETTERS_ONLY_PATTERN",
    "MONEY_TYPE",
    "email_local_part",
    "has_more_than_2_decimals",
    "is_not_letters_only",
    "parse_day_first_date",
    "round_money",
    "strip_non_letters",
    "year_of",
]
