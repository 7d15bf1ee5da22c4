"""Day-first order-date parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference tries these day-first patterns in this order.
REFERENCE_DATE_FORMATS = ("dd/M/yyyy", "dd/MM/yyyy", "d/M/yyyy")

# 'd' and 'M' accept one or two digits when parsing, so "d/M/yyyy" accepts
# every string the two stricter patterns accept and yields the same date
# (the unit tests pin this on the mixed spellings).  One parse per row
# instead of up to three.
DAY_FIRST_FORMATS = ("d/M/yyyy",)


def parse_day_first_date(c: Column | str, formats: Sequence[str] = DAY_FIRST_FORMATS) -> Column:
    """First successful ``try_to_date`` over ``formats``; unparseable -> null."""
    col = F.col(c) if isinstance(c, str) else c
    parsed = [F.try_to_date(col, fmt) for fmt in formats]
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


def year_of(c: Column | str) -> Column:
    """Calendar year as INT; null in, null out."""
    return F.year(F.col(c) if isinstance(c, str) else c)
