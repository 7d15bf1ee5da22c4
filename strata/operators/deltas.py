"""Incremental gold: the signed difference of two silver versions, applied to gold groups.

A silver version is a multiset of rows.  Its difference to another one is their
union with signs, and as gold sums exact decimals, the difference of two gold
tables is that union's sum per gold group: it combines map-side and never moves
silver rows.  Gold is kept with the number of order lines of each group, so a
group whose last line is deleted goes.  Only the years of groups that change are
written again (``plans.incremental``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import year_of
from strata.operators.gold import GOLD_KEYS

SIGN = "_sign"
LINES, PROFITS = "order_lines", "profit_lines"  # of a group: its lines, and those whose profit is not null


def signed_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of ``new`` with sign 1 and those of ``old`` with sign -1; equal rows cancel in any sum."""
    return new.withColumn(SIGN, F.lit(1)).unionByName(old.withColumn(SIGN, F.lit(-1)))


def signed_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """The multiset difference itself: each row that differs, with its copies in ``new`` less those in ``old``."""
    return (signed_rows(old, new).groupBy(*new.columns).agg(F.sum(SIGN).cast("int").alias(SIGN))
            .where(F.col(SIGN) != 0))


def gold_groups(silver_orders: DataFrame, sign: Column | None = None) -> DataFrame:
    """Gold with its number of order lines; with ``sign``, what signed rows add to both."""
    sign = F.lit(1) if sign is None else sign
    return (silver_orders
            .groupBy(year_of("Order_Date").alias("Year"), F.col("Category").alias("Product_Category"),
                     F.col("Sub_Category").alias("Product_Sub_Category"), "Customer_ID", "customer_name")
            .agg(F.round(F.sum(F.col("Profit") * sign), 2).cast("decimal(28,2)").alias("Profit"),
                 F.sum(F.when(F.col("Profit").isNotNull(), sign).otherwise(0)).cast("bigint").alias(PROFITS),
                 F.sum(sign).cast("bigint").alias(LINES)))


def gold_deltas(signed: DataFrame) -> DataFrame:
    """The gold groups that signed silver rows change, with the change of profit and lines."""
    deltas = gold_groups(signed, F.col(SIGN))
    return deltas.where((F.coalesce("Profit", F.lit(0)) != 0) | (F.col(PROFITS) != 0) | (F.col(LINES) != 0))


def apply_deltas(groups: DataFrame, deltas: DataFrame) -> DataFrame:
    """``groups`` after ``deltas``; groups without lines go.

    A negative number of lines stays in the result: it says that the deltas were
    not made from these groups, and the caller must refuse it.
    """
    return (groups.unionByName(deltas).groupBy(*GOLD_KEYS)
            .agg(F.sum("Profit").cast("decimal(28,2)").alias("Profit"), F.sum(PROFITS).cast("bigint").alias(PROFITS),
                 F.sum(LINES).cast("bigint").alias(LINES))
            .where(F.col(LINES) != 0)
            .withColumn("Profit", F.when(F.col(PROFITS) != 0, F.col("Profit"))))
