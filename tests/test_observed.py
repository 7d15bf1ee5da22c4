"""Checks that ride on the writes; the report lattice."""

import pytest

from conftest import SF_SMALL
from strata.operators import gold as G
from strata.operators import quality as Q
from strata.operators.observed import KeyedDimension, WriteChecks, key_counts
from strata.plans import catalog
from strata.plans.inspect import operator_count, physical_plan
from strata.plans.pipeline import check_tables, check_written, layer_tables
from strata.sources import variants as V
from strata.sources.sinks import write_table


@pytest.fixture(scope="module")
def observed(spark):
    checks = WriteChecks()
    names, _ = catalog._run(spark, SF_SMALL, "t_observed", checks=checks)
    return names, checks


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_the_report_is_the_same(spark, observed):
    names, checks = observed
    assert content(check_written(spark, checks, names)) == content(check_tables(spark, names))


def test_fewer_scans(spark, observed):
    names, checks = observed

    def scans(df):
        return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")

    assert scans(check_written(spark, checks, names)) == 7 < scans(check_tables(spark, names)) == 10


def test_planted_violations_are_counted_in_the_write(spark, observed):
    names, _ = observed
    checks, t = WriteChecks(), layer_tables(spark, names)
    planted = {"silver_customer": V.customers_null_key(t.silver_customer), "gold": V.gold_bad_year(t.gold),
               "bronze_orders": V.orders_bad_number(t.bronze_orders)}
    for layer, df in planted.items():
        write_table(df, names.gold(f"planted_{layer}"), dedup=layer == "bronze_orders", watch=checks.watch(layer),
                    partition_by=("Year",) if layer == "gold" else None)
    assert checks.metrics("silver_customer")["pk_null:customer_id"] == Q.pk_null_rows(planted["silver_customer"], "customer_id").count()
    assert checks.metrics("gold")["year_range:Year"] == Q.year_range_rows(planted["gold"]).count() > 0
    assert checks.metrics("gold")["rows"] == planted["gold"].count()
    bad = checks.metrics("bronze_orders")["bad_number:Profit"]
    assert bad == Q.bad_number_rows(planted["bronze_orders"]).dropDuplicates().count() > 0
    with pytest.raises(ValueError, match="silver_products has not been written"):
        checks.rows()


def test_other_layers_pass_unwatched(spark):
    df = spark.range(3)
    assert WriteChecks().watch("bronze_products")(df) is df


def test_key_counts(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (9, "a")], "c long, p string")
    customers = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "id long")
    products = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    got = key_counts(fact, [KeyedDimension("customers", "id", "fk_c", "c", customers), KeyedDimension("products", "id", "fk_p", "p", products)])
    assert content(got) == sorted([("fk_c", "silver_orders", "c", 1), ("pk_unique", "customers", "id", 1),
                                   ("fk_p", "silver_orders", "p", 2), ("pk_unique", "products", "id", 1)], key=repr)


# ---------------------------------------------------------------- report lattice

def test_lattice_equals_the_four_reports(spark):
    gold = catalog.build_layers(spark, SF_SMALL).gold
    lattice = G.report_lattice(gold)
    single = {"year": G.profit_by_year, "year_category": G.profit_by_year_category, "customer": G.profit_by_customer,
              "customer_year": G.profit_by_customer_year}
    for name, report in single.items():
        got, want = G.report_of(lattice, name), report(gold)
        assert got.columns == want.columns and content(got) == content(want)


def test_lattice_tells_null_keys_from_missing_columns(rows):
    gold = rows([(None, "c", "s", 1, None, 1.0), (2020, None, "s", None, "n", 2.0)],
                "Year int, Product_Category string, Product_Sub_Category string, Customer_ID long, customer_name string, Profit double")
    lattice = G.report_lattice(gold)
    assert lattice.groupBy("report").count().collect() and {r["report"]: r["count"] for r in lattice.groupBy("report").count().collect()} == {
        "year": 2, "year_category": 2, "customer": 2, "customer_year": 2}


def test_lattice_reads_gold_once_and_shuffles_once(spark, observed):
    plan = physical_plan(G.report_lattice(spark.table(observed[0].gold("profit"))))
    assert [operator_count(plan, o) for o in ("Scan", "Exchange", "Expand")] == [1, 1, 1]
