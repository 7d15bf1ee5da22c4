"""Planted defects (FIXTURES.md section 3) so every check has work to do.

Each variant is derived by Spark from a whole layer frame: the checks still
scan all rows, the variant only guarantees that some of them violate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the planted variants.
DUP_ORDER_EVERY = 50         # orders_dup: rows with Order_ID % 50 == 0 appear twice
DUP_CUSTOMER_EVERY = 200     # customers_dup_key: second row (country 'X') per key % 200 == 0
NULL_CUSTOMER_KEY_EVERY = 300
LOST_CATEGORY = "ECONOMY"    # products_lost: this category is missing from silver
DUP_GOLD_CUSTOMER_EVERY = 97  # gold_dup: groups of Customer_ID % 97 == 0 appear twice
NAN_PROFIT_EVERY = 251       # orders_bad_number: Profit NaN when Order_ID % 251 == 0
INFINITE_PROFIT_EVERY = 257  # and infinite when Order_ID % 257 == 0
HOT_CUSTOMER = 7             # customers_hot_key: every third customer's row again under this key
CHANGED_YEARS = (1996, 1997)  # orders_before: only orders of these years differ
INSERTED_EVERY, CORRECTED_EVERY, DELETED_EVERY = 10, 7, 11  # of Order_ID; remainders 3, 0 and 5
BAD_YEAR_CUSTOMER_BELOW = 30  # gold_bad_year: Year null / 1989 / 12000 by Customer_ID % 3


def orders_dup(bronze_orders: DataFrame) -> DataFrame:
    return bronze_orders.unionByName(bronze_orders.filter(F.col("Order_ID") % DUP_ORDER_EVERY == 0))


def orders_bad_number(bronze_orders: DataFrame) -> DataFrame:
    """Profit as DOUBLE, as an undeclared JSON source gives it, with NaN and infinite values."""
    k = F.col("Order_ID")
    return bronze_orders.withColumn(
        "Profit", F.when(k % NAN_PROFIT_EVERY == 0, F.lit(float("nan")))
        .when(k % INFINITE_PROFIT_EVERY == 0, F.lit(float("inf"))).otherwise(F.col("Profit").cast("double")))


def customers_dup_key(silver_customer: DataFrame) -> DataFrame:
    extra = (silver_customer.filter(F.col("customer_id") % DUP_CUSTOMER_EVERY == 0)
             .withColumn("country", F.lit("X")))
    return silver_customer.unionByName(extra)


def customers_hot_key(silver_customer: DataFrame) -> DataFrame:
    """Keys with two rows, null keys, and one key that holds a quarter of all rows, each with another country."""
    hot = (silver_customer.filter(F.col("customer_id") % 3 == 0)
           .withColumn("country", F.concat(F.lit("Z"), F.col("customer_id").cast("string")))
           .withColumn("customer_id", F.lit(HOT_CUSTOMER).cast(silver_customer.schema["customer_id"].dataType)))
    null = silver_customer.filter(F.col("customer_id") % NULL_CUSTOMER_KEY_EVERY == 0).withColumn(
        "customer_id", F.lit(None).cast(silver_customer.schema["customer_id"].dataType))
    return customers_dup_key(silver_customer).unionByName(hot).unionByName(null)


def orders_before(silver_orders: DataFrame) -> DataFrame:
    """An earlier version of silver orders: some lines not there yet, some with
    another profit, some that are deleted later (with a category of their own)."""
    year, k = F.year("Order_Date"), F.col("Order_ID")
    money = silver_orders.schema["Profit"].dataType
    early, late = (F.coalesce(year == y, F.lit(False)) for y in CHANGED_YEARS)
    there = silver_orders.filter(~(early & (k % INSERTED_EVERY == 3)))
    there = there.withColumn("Profit", F.when(late & (k % CORRECTED_EVERY == 0), F.col("Profit") + 1)
                             .otherwise(F.col("Profit")).cast(money))
    deleted = silver_orders.filter(early & (k % DELETED_EVERY == 5)).withColumn("Row_ID", -F.col("Row_ID")).withColumn(
        "Category", F.lit("GONE"))
    return there.unionByName(deleted)


def customers_null_key(silver_customer: DataFrame) -> DataFrame:
    k = F.col("customer_id")
    return silver_customer.withColumn(
        "customer_id", F.when(k % NULL_CUSTOMER_KEY_EVERY == 0, F.lit(None)).otherwise(k))


def products_lost(silver_products: DataFrame) -> DataFrame:
    return silver_products.filter(F.col("Category") != LOST_CATEGORY)


def gold_dup(gold: DataFrame) -> DataFrame:
    return gold.unionByName(gold.filter(F.col("Customer_ID") % DUP_GOLD_CUSTOMER_EVERY == 0))


def gold_bad_year(gold: DataFrame) -> DataFrame:
    cid = F.col("Customer_ID")
    bad = (F.when(cid % 3 == 0, F.lit(None).cast("int"))
           .when(cid % 3 == 1, F.lit(1989))
           .otherwise(F.lit(12000)))
    return gold.withColumn(
        "Year", F.when(cid < BAD_YEAR_CUSTOMER_BELOW, bad).otherwise(F.col("Year")))
