"""Money handling: round per row to cents, then add in fixed point.

Double sums depend on the order rows are added, i.e. on partitioning, so a
total computed on 8 cores and on 1000 executors can differ in the last bits.
After rounding each value to cents we hold it as DECIMAL(18,2): sums are exact
and identical on any cluster shape.  Rounding goes through Spark's ``round``
on the input's own type (HALF_UP on the decimal rendering, 1.005 -> 1.01),
so a DOUBLE source rounds exactly as it would without the decimal step.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_TYPE = "decimal(18,2)"


def round_money(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 2).cast(MONEY_TYPE)


def has_more_than_2_decimals(c: Column | str) -> Column:
    """Numeric test for "more than two decimal places": round(x, 2) <> x.

    Works for DOUBLE and DECIMAL alike, unlike reading digits off the string
    form (which misjudges 1.2E7 or 1.0E-4).  Null -> null (not a violation).
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 2) != col
