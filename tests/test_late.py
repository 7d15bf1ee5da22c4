"""Dimension rows that arrive after their orders; files of pretty-printed JSON."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators.deltas import LINES
from strata.operators.gold import gold_profit
from strata.operators.late import YEAR
from strata.operators.silver import join_dimensions
from strata.plans import catalog
from strata.plans.incremental import gold_rows, refresh_gold, write_gold_groups
from strata.plans.late import UNRESOLVED, resolve_late, write_orders_and_index
from strata.plans.publish import LayerStore
from strata.session import scratch_dir

ORDERS = "Row_ID long, Customer_ID long, Product_ID long, Profit decimal(18,2), Order_Date date"
CUSTOMERS, PRODUCTS = "customer_id long, customer_name string, country string", "Product_ID long, Category string, Sub_Category string"


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def data(spark):
    """Customers 1-3 and products 1-2 are there; customer 4 has orders in 1995, product 3 in 1997 and without a date, 9 never comes."""
    day = lambda y: y and dt.date(y, 3, 1)
    rows = [(1, 1, 1, 1995), (2, 2, 2, 1996), (3, 4, 1, 1995), (4, 4, 2, 1995), (5, 3, 3, 1997), (6, 3, 3, None), (7, 9, 1, 1996),
            (8, None, 1, 1994), (9, 1, 2, 1998)]
    orders = spark.createDataFrame([(i, c, p, None, day(y)) for i, c, p, y in rows], ORDERS).withColumn("Profit", F.col("Row_ID").cast("decimal(18,2)"))
    customers = spark.createDataFrame([(c, f"n{c}", "X") for c in (1, 2, 3, 4)], CUSTOMERS)
    products = spark.createDataFrame([(p, f"c{p}", "s") for p in (1, 2, 3)], PRODUCTS)
    return orders, customers, products


def stored(spark, orders, customers, products):
    store = LayerStore(spark, scratch_dir(spark, "t-late"))
    with store.run() as run:
        run.write(customers, "silver.silver_customer", dedup=False)
        run.write(products, "silver.silver_products", dedup=False)
        silver = write_orders_and_index(run, join_dimensions(orders, customers, products))
        write_gold_groups(run, silver, "gold.profit")
    return store


def parts(store, table):
    return dict(store.version().tables[table].parts)


def test_index_of_unresolved_keys(spark, data):
    orders, customers, products = data
    store = stored(spark, orders, customers.where("customer_id < 4"), products.where("Product_ID < 3"))
    assert content(store.read("silver.silver_customer" + UNRESOLVED)) == [(4, 1995), (9, 1996)]
    assert content(store.read("silver.silver_products" + UNRESOLVED)) == [(3, 1997), (3, None)]


@pytest.mark.parametrize("late, years", [("customer", [1995]), ("product", [1997, None]), ("both", [1995, 1997, None]), ("none", [])])
def test_only_the_years_with_arrivals_are_written(spark, data, late, years):
    orders, customers, products = data
    early_c = customers.where("customer_id < 4") if late in ("customer", "both") else customers
    early_p = products.where("Product_ID < 3") if late in ("product", "both") else products
    store = stored(spark, orders, early_c, early_p)
    before, gold_before = parts(store, "silver.silver_orders"), parts(store, "gold.profit")
    with store.run() as run:
        found, signed = resolve_late(run, customers, products)
        if found:
            assert refresh_gold(run, "gold.profit", signed) == years
    assert found == years
    want = join_dimensions(orders, customers, products)
    got = store.read("silver.silver_orders").drop(YEAR)
    assert got.columns == want.columns and content(got) == content(want)
    assert content(gold_rows(store.read("gold.profit"))) == content(gold_profit(want)) and store.read("gold.profit").where(f"{LINES} < 1").isEmpty()
    names = {f"{YEAR}={y if y else '__HIVE_DEFAULT_PARTITION__'}" for y in years}
    after = parts(store, "silver.silver_orders")
    assert {n for n in after if after[n] != before[n]} == names
    after = parts(store, "gold.profit")
    assert {n.replace("Year", YEAR) for n in after if after[n] != gold_before[n]} == names
    assert content(store.read("silver.silver_customer" + UNRESOLVED)) == [(9, 1996)]


def test_a_key_with_most_rows_makes_no_large_file(spark):
    """Pretty-printed files hold a bounded number of records, whatever the order ids."""
    orders = spark.range(12_000).selectExpr("id AS Row_ID", "if(id % 3 = 0, 7, if(id % 3 = 1, null, id)) AS Order_ID").repartition(2)
    path = f"{scratch_dir(spark, 't-json')}/orders"
    catalog._write_json_arrays(orders, path)
    read = spark.read.schema("Row_ID long, Order_ID long").option("multiLine", True).json(path)
    assert content(read) == content(orders)
    sizes = [r["count"] for r in read.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= catalog.RECORDS_PER_FILE and len(sizes) >= 3
