"""One row per dimension key, and the rows that lost."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.operators import silver
from strata.operators.survivorship import LOST, NULL_KEY, losing_rows, survivors
from strata.plans import catalog
from strata.plans.pipeline import CUSTOMER_RULES
from strata.sources import variants as V
from strata.sources.adapters import load_bronze

DDL = "customer_id long, customer_name string, country string"


def split(df, keys=("customer_id",), prefer=()):
    winners = survivors(df, keys, prefer)
    assert winners.columns == df.columns
    lost = losing_rows(df, winners, keys)
    return sorted(map(tuple, winners.collect())), sorted(map(tuple, lost.collect()), key=repr)


def test_rules_ties_nulls_and_copies(rows):
    df = rows([(1, None, "Z"), (1, "Ann", "A"), (2, "Bo", "A"), (2, "Bo", "B"), (2, "Bo", "A"), (None, "X", "A"), (None, "X", "A"),
               (3, None, None), (4, "Cy", "A"), (4, "Cy", "A")], DDL)
    winners, lost = split(df, prefer=[F.col("customer_name").isNotNull()])
    assert winners == [(1, "Ann", "A"), (2, "Bo", "B"), (3, None, None), (4, "Cy", "A")]
    assert lost == sorted([(1, None, "Z", LOST), (2, "Bo", "A", LOST), (None, "X", "A", NULL_KEY)], key=repr)


def test_latest_row_and_keys_of_two_columns(rows):
    df = rows([(1, "a", 5, "old"), (1, "a", 7, "new"), (1, "b", 1, "only"), (1, None, 9, "no key")], "x int, y string, day int, v string")
    winners, lost = split(df, ("x", "y"), [F.col("day")])
    assert winners == [(1, "a", 7, "new"), (1, "b", 1, "only")]
    assert [r[-1] for r in lost] == [LOST, NULL_KEY]


def test_only_key_columns_and_no_rows(rows):
    assert split(rows([(1,), (1,)], "customer_id long")) == ([(1,)], [])
    assert split(rows([], DDL)) == ([], [])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3) | st.none(), st.sampled_from(["a", "b"]) | st.none(), st.sampled_from("XY")), min_size=1, max_size=12))
def test_winners_and_losers_are_all_rows(spark, given_rows):
    winners, lost = split(spark.createDataFrame(given_rows, DDL))
    assert sorted(winners + [r[:3] for r in lost], key=repr) == sorted(set(given_rows), key=repr)
    assert len({w[0] for w in winners}) == len(winners) == len({r[0] for r in given_rows} - {None})


def test_orders_are_not_multiplied(spark):
    b = load_bronze(spark, SF_SMALL)
    customers = V.customers_hot_key(silver.enrich_customers(b.customer))
    hot = customers.where(f"customer_id = {V.HOT_CUSTOMER}").count()
    assert hot > customers.count() / 5
    one = survivors(customers, ("customer_id",), [F.expr(r) for r in CUSTOMER_RULES])
    orders = silver.parse_orders(b.orders).dropDuplicates()
    plain = silver.join_dimensions(orders, customers, silver.enrich_products(b.products))
    unique = silver.join_dimensions(orders, one, silver.enrich_products(b.products))
    assert unique.count() == orders.count() < plain.count()


def test_winners_combine_before_the_shuffle(spark):
    """A hot key sends one row a map task: a partial maximum stands below the only exchange."""
    plan = survivors(spark.range(100).selectExpr("id % 2 AS k", "id AS v"), ("k",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max" in plan.split("Exchange hashpartitioning")[1]


def test_pipeline_option(spark):
    from strata.plans.pipeline import REJECTED, prepare_schemas, process_bronze, process_silver, ingest_table
    from strata.session import scratch_dir

    root = scratch_dir(spark, "t-unique")
    sources = catalog._land_files(spark, SF_SMALL, root)
    names = catalog._run_names(spark, "unique")
    prepare_schemas(spark, names, root)
    process_bronze(spark, sources.products, names.bronze(names.bronze_products))
    process_bronze(spark, sources.orders, names.bronze(names.bronze_orders))
    spark.table(sources.customer.path).createOrReplaceTempView("sheet")
    twice = spark.sql("SELECT * FROM sheet UNION ALL SELECT customer_id, customer_name, email, 'ATLANTIS' FROM sheet WHERE customer_id % 5 = 0")
    twice.write.saveAsTable(names.bronze("sheet"))
    ingest_table(spark, names.bronze("sheet"), names.bronze(names.bronze_customer))
    tables = process_silver(spark, names, unique_keys=True)
    assert tables.orders.count() == spark.table(names.bronze(names.bronze_orders)).count()
    lost = spark.table(names.silver(names.silver_customer + REJECTED))
    assert lost.count() == spark.table("sheet").where("customer_id % 5 = 0").count() and spark.table(names.silver(names.silver_products + REJECTED)).count() == 0
