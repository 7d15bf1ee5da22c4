"""Gold that follows silver without being rebuilt, in a versioned store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.deltas import LINES, apply_deltas, gold_deltas, gold_groups, signed_rows
from strata.operators.gold import GOLD_KEYS
from strata.plans.publish import Run
from strata.sources.sinks import materialize


def write_gold_groups(run: Run, silver_orders: DataFrame, table: str) -> DataFrame:
    """The whole gold table with its line counts, partitioned by Year."""
    return run.write(gold_groups(silver_orders), table, dedup=False, partition_by="Year")


def gold_rows(groups: DataFrame) -> DataFrame:
    """Gold as readers know it, from the groups with their line counts."""
    return groups.select(*GOLD_KEYS, "Profit")


def in_years(years: list, column: str = "Year") -> Column:
    """Whether the year is one of ``years``, null included if listed: a predicate that prunes partitions."""
    known = [y for y in years if y is not None]
    wanted = F.col(column).isin(known) if known else F.lit(False)
    return wanted | F.col(column).isNull() if None in years else wanted


def refresh_gold(run: Run, table: str, signed: DataFrame) -> list:
    """Applies signed silver rows to the staged or current gold ``table``; returns the years written again.

    ``signed``: ``signed_rows(old silver, new silver)``, or the changed rows
    alone with their signs where a change feed gives them.  The deltas are stored
    once: they are read for the list of years (as long as the table has
    partitions) and for the update, which reads only those years' files.  Rows
    that do not fit the table (more deletions than lines) are refused, and the
    run then publishes nothing.
    """
    deltas = materialize(gold_deltas(signed), "gold-deltas")
    years = sorted((r["Year"] for r in deltas.select("Year").distinct().collect()), key=lambda y: (y is None, y))
    if not years:
        return []
    touched = run.read(table).where(in_years(years))
    staged = run.replace_partitions(apply_deltas(touched, deltas), table, years)
    broken = staged.where(in_years(years) & (F.col(LINES) < 0))
    if not broken.isEmpty():
        raise ValueError(f"the changes do not fit {table}: {broken.first()}")
    return years


def refresh_gold_from_versions(run: Run, table: str, old_silver: DataFrame, new_silver: DataFrame) -> list:
    columns = ["Order_Date", "Category", "Sub_Category", "Customer_ID", "customer_name", "Profit"]
    return refresh_gold(run, table, signed_rows(old_silver.select(*columns), new_silver.select(*columns)))
