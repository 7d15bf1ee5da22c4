"""Shape the provided star-schema tables into the three bronze inputs.

The reference lands orders (JSON), products (CSV) and customers (a table);
the test data is a TPC-H-like star schema.  These adapters derive bronze
frames from it with plain DataFrame expressions, so every query downstream
reads the whole given tables and its work grows with them.  The shapes and
the planted noise (unparseable dates, orphan keys, null names) are those of
FIXTURES.md section 2.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the test-data mapping (FIXTURES.md section 2).
BAD_DATE_EVERY = 97          # Order_Date 'n/a' when l_orderkey % 97 == 0
ORPHAN_CUSTOMER_EVERY = 101  # Customer_ID pushed out of range when l_orderkey % 101 == 0
ORPHAN_PRODUCT_EVERY = 103   # Product_ID pushed out of range when l_orderkey % 103 == 0
ORPHAN_KEY_OFFSET = 1_000_000_000_000_000  # above any real key: customer and part
                                         # keys stay below 10^11 at SF 100,000
NULL_NAME_EVERY = 10         # customer_name null when c_custkey % 10 == 0
PROFIT_MARGIN = "0.05"       # Profit = price * (0.05 - discount)

TPCH_TABLES = ("lineitem", "orders", "customer", "nation", "part")


def read_tpch(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its files are listed anew on every call."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_orders_frame(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines as the raw orders file would hold them.

    Order_Date is a day-first string in three spellings (plus 'n/a'), some
    customer/product keys have no dimension row, Profit has four decimals.
    """
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                         "l_extendedprice", "l_discount", "l_linestatus", "l_shipdate")
    od = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("l_orderkey")
    order_date = (
        F.when(k % BAD_DATE_EVERY == 0, F.lit("n/a"))
        .when(k % 4 == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(k % 4 == 1, F.date_format("o_orderdate", "dd/M/yyyy"))
        .otherwise(F.date_format("o_orderdate", "d/M/yyyy"))
    )
    margin = F.lit(PROFIT_MARGIN).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    profit = (F.col("l_extendedprice").cast("decimal(12,2)") * margin).cast("decimal(18,4)")
    # Fact-to-fact join: sort-merge at any real scale, so say so; a broadcast
    # of orders would also funnel the whole lineitem side through the scan tasks.
    return li.join(od.hint("merge"), li.l_orderkey == od.o_orderkey).select(
        (k * 10 + F.col("l_linenumber")).alias("Row_ID"),
        k.alias("Order_ID"),
        order_date.alias("Order_Date"),
        F.date_format("l_shipdate", "d/M/yyyy").alias("Ship_Date"),
        F.col("l_linestatus").alias("Ship_Mode"),
        F.when(k % ORPHAN_CUSTOMER_EVERY == 0, F.col("o_custkey") + ORPHAN_KEY_OFFSET)
        .otherwise(F.col("o_custkey")).alias("Customer_ID"),
        F.when(k % ORPHAN_PRODUCT_EVERY == 0, F.col("l_partkey") + ORPHAN_KEY_OFFSET)
        .otherwise(F.col("l_partkey")).alias("Product_ID"),
        F.col("l_quantity").alias("Quantity"),
        F.col("l_extendedprice").alias("Price"),
        F.col("l_discount").alias("Discount"),
        profit.alias("Profit"),
    )


def bronze_customer_frame(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Customer sheet: lower-case headers, names with digits/symbols, PII."""
    c = customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    n = nation.select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        key.alias("customer_id"),
        F.when(key % NULL_NAME_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.concat("c_name", F.lit(" "), "c_mktsegment")).alias("customer_name"),
        F.concat(F.lower("c_mktsegment"), F.lit("."), key.cast("string"),
                 F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country"),
    )


def bronze_products_frame(part: DataFrame) -> DataFrame:
    """Product catalogue with the columns the CSV carries."""
    return part.select(
        F.col("p_partkey").alias("Product_ID"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Sub_Category"),
        F.col("p_name").alias("Product_Name"),
        F.col("p_retailprice").alias("Price_per_product"),
    )


@dataclass(frozen=True)
class Bronze:
    orders: DataFrame
    customer: DataFrame
    products: DataFrame


def load_bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    t = {name: read_tpch(spark, sf_dir, name) for name in TPCH_TABLES}
    return Bronze(
        orders=bronze_orders_frame(t["lineitem"], t["orders"]),
        customer=bronze_customer_frame(t["customer"], t["nation"]),
        products=bronze_products_frame(t["part"]),
    )
