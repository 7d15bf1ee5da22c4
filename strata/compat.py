"""Drop-in names for callers of the original notebook utilities.

The function and parameter names are fixed values (callers use them).  Same function names and argument order, implemented with this library.
Differences, on purpose:
* every check really checks: it raises ``AssertionError`` with the number of
  violations (the originals could pass whatever the data);
* ``write_to_delta_table`` takes ``fmt`` (default parquet; pass "delta" where
  Delta is installed);
* money is exact DECIMAL(18,2) after silver, so totals do not depend on
  partitioning;
* ``check_sum_profit_across_layers`` compares per-row-rounded bronze with
  silver and gold (the raw comparison fails on sound data; see README D6).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import gold as _gold
from strata.operators import quality as Q
from strata.operators import silver as _silver
from strata.operators.naming import clean_column_names
from strata.plans.pipeline import write_silver
from strata.settings import LayerNames, SourceSpec
from strata.sources.readers import read_catalogue_table, read_csv, read_json, read_source
from strata.sources.sinks import write_table


# ---------------------------------------------------------------- sources/sinks

def read_csv_file(spark: SparkSession, csv_file_path: str, header: bool = True,
                  infer_schema: bool = True, delimiter: str = ",") -> DataFrame:
    return read_csv(spark, csv_file_path, header=header, infer_schema=infer_schema, delimiter=delimiter)


def read_json_file(spark: SparkSession, json_file_path: str, infer_schema: bool = True,
                   multi_line: bool = True) -> DataFrame:
    """``infer_schema`` has no effect, as in Spark: JSON is inferred unless a schema is given."""
    return read_json(spark, json_file_path, multi_line=multi_line)


def write_to_delta_table(spark: SparkSession, catalog: str, schema: str, table_name: str,
                         df: DataFrame, fmt: str = "parquet") -> None:
    write_table(df, f"{catalog}.{schema}.{table_name}", fmt=fmt)


def clean_dataframe_column_names(df: DataFrame) -> DataFrame:
    return clean_column_names(df)


def read_table_from_catalogue(spark: SparkSession, catalog: str, schema: str,
                              table_name: str) -> DataFrame:
    return read_catalogue_table(spark, catalog, schema, table_name)


# ---------------------------------------------------------------- layers

def enrich_customer_data(customer_df: DataFrame) -> DataFrame:
    return _silver.enrich_customers(customer_df)


def enrich_products_data(product_df: DataFrame) -> DataFrame:
    return _silver.enrich_products(product_df)


def enrich_orders_data(order_df: DataFrame, customer_df: DataFrame, product_df: DataFrame) -> DataFrame:
    return _silver.enrich_orders(order_df, customer_df, product_df)


def enrich_gold_profit_df(silver_orders_df: DataFrame) -> DataFrame:
    return _gold.gold_profit(silver_orders_df)


def process_bronze(source_file_path: str, source_file_type: str, target_table_name: str,
                   catalogue_name: str, schema_name: str, spark: SparkSession,
                   fmt: str = "parquet") -> DataFrame:
    options = {"multi_line": True} if source_file_type.lower() == "json" else {}
    df = clean_column_names(read_source(spark, SourceSpec(source_file_path, source_file_type, options=options)))
    write_table(df, f"{catalogue_name}.{schema_name}.{target_table_name}", fmt=fmt)
    return df


def process_silver(spark: SparkSession, customer_df: DataFrame, orders_df: DataFrame,
                   products_df: DataFrame, silver_orders_dst_table_name: str,
                   silver_customer_dst_table_name: str, silver_products_dst_table_name: str,
                   silver_dst_schema_name: str, dst_catalogue_name: str,
                   fmt: str = "parquet") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns (customers, products, orders) as written."""
    def write(df: DataFrame, table: str) -> DataFrame:
        name = f"{dst_catalogue_name}.{silver_dst_schema_name}.{table}"
        write_table(df, name, fmt, dedup=False)
        return spark.table(name)

    names = LayerNames(bronze_customer="customer", bronze_orders="orders", bronze_products="products",
                       silver_customer=silver_customer_dst_table_name, silver_orders=silver_orders_dst_table_name,
                       silver_products=silver_products_dst_table_name)
    tables = write_silver(customer_df, orders_df, products_df, names, write)
    return tables.customer, tables.products, tables.orders


def process_gold_table(spark: SparkSession, silver_orders_df: DataFrame, dst_catalogue_name: str,
                       gold_dst_schema_name: str, gold_dst_table_name: str,
                       fmt: str = "parquet") -> None:
    write_table(_gold.gold_profit(silver_orders_df),
                f"{dst_catalogue_name}.{gold_dst_schema_name}.{gold_dst_table_name}", fmt, dedup=False)


# ---------------------------------------------------------------- checks

def _none(rows: DataFrame, message: str) -> None:
    n = rows.count()
    assert n == 0, f"{message}: {n} violation(s)"


def primary_key_null_check(df: DataFrame, primary_key: str) -> None:
    _none(Q.pk_null_rows(df, primary_key), f"primary key {primary_key} is null")


def primary_key_unique_check(df: DataFrame, primary_key: str) -> None:
    _none(Q.duplicate_keys(df, primary_key), f"primary key {primary_key} is not unique")


def check_string_datatype_column(df: DataFrame, column_to_check: str) -> None:
    assert Q.is_string_column(df, column_to_check), f"column {column_to_check} is not a string"


def check_date_time_format(df: DataFrame, column_name: str) -> None:
    assert Q.is_date_column(df, column_name), f"column {column_name} is not a date/timestamp"


def check_decimal_format(df: DataFrame, column_to_check: str) -> None:
    _none(Q.excess_decimal_rows(df, column_to_check), f"{column_to_check} has more than 2 decimals")


def check_column_availability(df: DataFrame, column_lists: Sequence[str]) -> None:
    missing = Q.missing_columns(df, column_lists)
    assert not missing, f"columns not available: {missing}"


def check_empty_dataframe(df: DataFrame) -> None:
    assert Q.is_non_empty(df), "DataFrame is empty"


def check_sum_profit_across_layers(bronze_order: DataFrame, silver_orders: DataFrame,
                                   gold_profit: DataFrame) -> None:
    r = Q.profit_totals(bronze_order, silver_orders, gold_profit).first()
    assert r["passed"], (f"profit differs across layers: bronze {r['bronze_rounded_profit']}, "
                         f"silver {r['silver_profit']}, gold {r['gold_profit']}")


def check_unique_product_category_sub_category(df_silver: DataFrame, df_bronze: DataFrame) -> None:
    _none(Q.category_counts(df_silver, df_bronze).filter(~F.col("passed")),
          "category / sub-category counts differ between layers")


def check_proper_grouping_gold_profit_data(df_gold: DataFrame) -> None:
    _none(Q.gold_grouping_violations(df_gold), "gold profit is not properly grouped")


def check_customer_name_format(df: DataFrame) -> None:
    _none(Q.name_format_rows(df), "customer_name contains non-letters")


def check_year_range(df: DataFrame) -> None:
    _none(Q.year_range_rows(df), f"Year outside {Q.YEAR_MIN}-{Q.YEAR_MAX} or not 4 digits")


def check_order_to_customer_enriched_foreignkeyintegrity(enriched_order_df: DataFrame,
                                                         enriched_customer_df: DataFrame) -> None:
    _none(Q.missing_keys(enriched_order_df, "Customer_ID", enriched_customer_df, "customer_id"),
          "order customer IDs missing from customers")


def check_order_to_product_enriched_foreignkeyintegrity(enriched_order_df: DataFrame,
                                                        enriched_products_df: DataFrame) -> None:
    _none(Q.missing_keys(enriched_order_df, "Product_ID", enriched_products_df, "Product_ID"),
          "order product IDs missing from products")


def validate_aggregated_profit_accuracy(enriched_orders_df: DataFrame,
                                        aggregated_profit_df: DataFrame) -> None:
    _none(Q.gold_mismatches(enriched_orders_df, aggregated_profit_df),
          "gold profit differs from silver per group")
