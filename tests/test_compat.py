"""The drop-in names on the adapters' data: checks that hold pass, planted ones raise."""

import pytest

from conftest import SF_SMALL
from strata import compat as C
from strata.plans.pipeline import prepare_schemas
from strata.plans.catalog import _run_names
from strata.session import scratch_dir
from strata.sources.adapters import load_bronze


@pytest.fixture(scope="module")
def layers(spark):
    b = load_bronze(spark, SF_SMALL)
    sc = C.enrich_customer_data(b.customer)
    sp = C.enrich_products_data(b.products)
    so = C.enrich_orders_data(b.orders, sc, sp)
    return b, sc, sp, so, C.enrich_gold_profit_df(so)


def test_checks_that_hold(layers):
    b, sc, sp, so, g = layers
    C.primary_key_null_check(sc, "customer_id")
    C.primary_key_unique_check(sc, "customer_id")
    C.primary_key_unique_check(sp, "product_id")  # case-insensitive, as in Spark
    C.check_customer_name_format(sc)
    C.check_date_time_format(so, "Order_Date")
    C.check_string_datatype_column(b.customer, "customer_name")
    C.check_decimal_format(so, "Profit")
    C.check_column_availability(sp, ["Product_ID", "Category", "Sub_Category"])
    C.check_empty_dataframe(so)
    C.check_sum_profit_across_layers(b.orders, so, g)
    C.check_unique_product_category_sub_category(sp, b.products)
    C.check_proper_grouping_gold_profit_data(g)
    C.validate_aggregated_profit_accuracy(so, g)


def test_checks_that_fail_on_planted_noise(layers):
    b, sc, sp, so, g = layers
    with pytest.raises(AssertionError):
        C.check_year_range(g)  # unparseable dates give null years
    with pytest.raises(AssertionError):
        C.check_order_to_customer_enriched_foreignkeyintegrity(so, sc)
    with pytest.raises(AssertionError):
        C.check_order_to_product_enriched_foreignkeyintegrity(so, sp)
    with pytest.raises(AssertionError):
        C.check_decimal_format(b.orders, "Profit")
    with pytest.raises(AssertionError):
        C.check_customer_name_format(b.customer)
    with pytest.raises(AssertionError):
        C.check_column_availability(sp, ["product_id"])


def test_pipeline_names(spark, layers):
    b, *_ = layers
    root = scratch_dir(spark, "t-compat")
    names = _run_names(spark, "compat")
    prepare_schemas(spark, names, root)
    sc, sp, so = C.process_silver(spark, b.customer, b.orders, b.products, "so", "sc", "sp",
                                  names.silver_schema, names.catalog)
    C.process_gold_table(spark, so, names.catalog, names.gold_schema, "profit")
    g = C.read_table_from_catalogue(spark, names.catalog, names.gold_schema, "profit")
    C.validate_aggregated_profit_accuracy(so, g)
    with pytest.raises(ValueError, match="Invalid source file type"):
        C.process_bronze("/x/Customer.xlsx", "xlsx", "t", names.catalog, names.bronze_schema, spark)
