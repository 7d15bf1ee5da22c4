"""Gold layer: profit by year x category x sub-category x customer, and roll-ups.

All of these are one hash aggregation each: Spark computes partial sums in
every map task and shuffles one row per group per task, so a group holding a
third of all rows costs no more shuffle than any other.  Profit arrives as
DECIMAL(18,2) from silver, so every sum here is exact and independent of how
the rows are partitioned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import year_of

GOLD_KEYS = ("Year", "Product_Category", "Product_Sub_Category", "Customer_ID", "customer_name")


def _rounded_total(column: str, alias: str):
    return F.round(F.sum(column), 2).alias(alias)


def gold_profit(silver_orders: DataFrame) -> DataFrame:
    """One row per (Year, Product_Category, Product_Sub_Category, Customer_ID,
    customer_name) with the rounded profit sum; null keys form their own groups.

    Written as a single grouping set, so that the sums are dealt out by all five
    keys.  As a plain ``groupBy`` they keep the partitions of the customer join,
    if that is the last shuffle: a task then sorts for the join and holds the
    groups of its rows twice, as partial and as final sums, and a hot customer
    stays in one task.
    """
    rows = silver_orders.select(year_of("Order_Date").alias("Year"),
                                F.col("Category").alias("Product_Category"),
                                F.col("Sub_Category").alias("Product_Sub_Category"),
                                F.col("Customer_ID"),
                                F.col("customer_name"),
                                F.col("Profit"))
    keys = [F.col(k) for k in GOLD_KEYS]
    return rows.groupingSets([keys], *keys).agg(_rounded_total("Profit", "Profit"))


# The reports keep the reference's output name for the total in all four.
REPORT_TOTAL = "total_profit_by_year"


def profit_by_year(gold: DataFrame) -> DataFrame:
    return gold.groupBy("Year").agg(_rounded_total("Profit", REPORT_TOTAL)).orderBy(F.desc("Year"))


def profit_by_year_category(gold: DataFrame) -> DataFrame:
    return (gold.groupBy("Year", "Product_Category")
            .agg(_rounded_total("Profit", REPORT_TOTAL)).orderBy(F.desc("Year")))


def profit_by_customer(gold: DataFrame) -> DataFrame:
    return (gold.groupBy("Customer_ID", "customer_name")
            .agg(_rounded_total("Profit", REPORT_TOTAL)).orderBy(F.desc(REPORT_TOTAL)))


def profit_by_customer_year(gold: DataFrame) -> DataFrame:
    return (gold.groupBy("Year", "Customer_ID")
            .agg(_rounded_total("Profit", REPORT_TOTAL)).orderBy(F.desc("Year")))


#: The four reports by their grouping columns.
REPORTS = {
    "year": ("Year",),
    "year_category": ("Year", "Product_Category"),
    "customer": ("Customer_ID", "customer_name"),
    "customer_year": ("Year", "Customer_ID"),
}
LATTICE_KEYS = ("Year", "Product_Category", "Customer_ID", "customer_name")


def report_lattice(gold: DataFrame) -> DataFrame:
    """All four reports at once: (report, Year, Product_Category, Customer_ID, customer_name, total).

    Grouping sets: gold is read once, each row stands once for every report
    (Expand) and is summed up before the one shuffle.  ``report`` comes from the
    grouping id, so a null key of a group is not mistaken for a column that the
    report does not group by.  Keys that a report lacks are null.
    """
    def bits(keys):  # of the grouping id: 1 for a column that is not grouped by
        return sum(1 << (len(LATTICE_KEYS) - 1 - i) for i, k in enumerate(LATTICE_KEYS) if k not in keys)

    name = F.lit(None).cast("string")
    for report, keys in REPORTS.items():
        name = F.when(F.col("_set") == bits(keys), report).otherwise(name)
    sums = gold.groupingSets([[F.col(k) for k in keys] for keys in REPORTS.values()], *LATTICE_KEYS).agg(
        _rounded_total("Profit", REPORT_TOTAL), F.grouping_id().alias("_set"))
    return sums.select(name.alias("report"), *LATTICE_KEYS, REPORT_TOTAL)


def report_of(lattice: DataFrame, report: str) -> DataFrame:
    """One report of a (stored) lattice, with its own columns and order."""
    rows = lattice.where(F.col("report") == report).select(*REPORTS[report], REPORT_TOTAL)
    return rows.orderBy(F.desc(REPORT_TOTAL if report == "customer" else "Year"))


def silver_category_profit(silver_orders: DataFrame) -> DataFrame:
    """Cross-check straight from silver: unrounded sum by order year, category, sub-category."""
    return (silver_orders
            .groupBy(year_of("Order_Date").alias("order_year"), "Category", "Sub_Category")
            .agg(F.sum("Profit").alias("profit")))
