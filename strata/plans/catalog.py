"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the whole given tables (through the bronze adapters); money
leaves as DOUBLE so results compare across engines.  The returned frame is
lazy, but a query that reads a layer several times, or that is about writing,
first runs the jobs that store it (``dq_report``, ``dq_gold_*``,
``dq_profit_layers`` and everything under "sources/sinks").  What they store
stays until ``session.release_scratch``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import gold, silver
from strata.operators import quality as Q
from strata.operators.late import YEAR
from strata.operators.naming import clean_column_names
from strata.operators.observed import WriteChecks
from strata.operators.survivorship import losing_rows, survivors
from strata.plans.layers import GOLD_INPUTS, build_layers, decimals_as_double
from strata.plans.pipeline import (
    CUSTOMER_RULES,
    QUARANTINE,
    MedallionSources,
    check_tables,
    check_written,
    gold_of,
    ingest_table,
    prepare_schemas,
    process_bronze,
    process_gold,
    process_silver,
    publish_medallion,
    run_medallion,
)
from strata.plans.incremental import gold_rows, refresh_gold, refresh_gold_from_versions, write_gold_groups
from strata.plans.late import resolve_late, write_orders_and_index
from strata.plans.publish import LayerStore
from strata.session import scratch_dir, scratch_schema, shuffles_dropped
from strata.settings import LayerNames, SourceSpec
from strata.sources import variants as V
from strata.sources.adapters import load_bronze
from strata.sources.quarantine import read_split
from strata.sources.readers import read_csv, read_json, read_table
from strata.sources.sinks import staged, write_table

Query = Callable[[SparkSession, str], DataFrame]


def silver_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.enrich_customers(load_bronze(spark, sf_dir).customer)


def silver_customer_email_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.enrich_customers(load_bronze(spark, sf_dir).customer, email_fallback=True)


def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.enrich_products(load_bronze(spark, sf_dir).products)


def orders_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(silver.parse_orders(load_bronze(spark, sf_dir).orders))


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(build_layers(spark, sf_dir).silver_orders)


def gold_profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(build_layers(spark, sf_dir).gold)


def report_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(gold.profit_by_year(build_layers(spark, sf_dir).gold))


def report_year_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(gold.profit_by_year_category(build_layers(spark, sf_dir).gold))


def report_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(gold.profit_by_customer(build_layers(spark, sf_dir).gold))


def report_customer_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(gold.profit_by_customer_year(build_layers(spark, sf_dir).gold))


def report_silver_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(gold.silver_category_profit(build_layers(spark, sf_dir).silver_orders))


def report_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four gold reports from one scan of gold and one shuffle."""
    return decimals_as_double(gold.report_lattice(build_layers(spark, sf_dir).gold))


QUERIES: dict[str, Query] = {
    "report_lattice": report_lattice,
    "silver_customer": silver_customer,
    "silver_customer_email_fallback": silver_customer_email_fallback,
    "silver_products": silver_products,
    "orders_date_parse": orders_date_parse,
    "silver_orders": silver_orders,
    "gold_profit": gold_profit,
    "report_year": report_year,
    "report_year_category": report_year_category,
    "report_customer": report_customer,
    "report_customer_year": report_customer_year,
    "report_silver_category": report_silver_category,
}


# ------------------------------------------------------------------ checks
# Each check runs over a whole layer; where the clean layer would give no
# rows, a planted variant (strata.sources.variants) guarantees violations.
# A check that reads a layer several times stores that layer once in the
# shared scratch folder (as it would read the pipeline's tables) and scans
# the copy.  Silver orders feeds gold and the check, so it is stored (only the
# columns that are read, where the check is not about all of them); gold when
# the check reads it twice.  The silver dimensions are stored for the full
# report, which reads each of them three times.  Bronze orders is read by
# silver and by one scan of the report, which needs two of its columns: that
# is cheaper recomputed than written.


def dq_pk_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.pk_null_rows(V.customers_null_key(silver_customer(spark, sf_dir)), "customer_id")


def dq_pk_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_keys(V.customers_dup_key(silver_customer(spark, sf_dir)), "customer_id")


def dq_date_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(Q.unparsed_date_rows(load_bronze(spark, sf_dir).orders))


def dq_decimal_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Q.excess_decimal_rows(load_bronze(spark, sf_dir).orders, "Profit")
    return decimals_as_double(rows.select("Row_ID", "Order_ID", "Profit"))


def dq_non_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projection, de-duplication and left joins never empty a layer, so each
    silver table has rows exactly if its bronze input has (README D11): the
    probe reads the inputs, without the de-duplication or the joins."""
    b = load_bronze(spark, sf_dir)
    return (Q.empty_table_row(b.customer.select("customer_id"), "silver_customer")
            .unionByName(Q.empty_table_row(b.products.select("Product_ID"), "silver_products"))
            .unionByName(Q.empty_table_row(b.orders.select("Row_ID"), "silver_orders")))


def dq_non_empty_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 on tables that lost their rows: no product has this category, no customer this key."""
    b = load_bronze(spark, sf_dir)
    return (Q.empty_table_row(b.products.filter("Category = 'none such'"), "no_products")
            .unionByName(Q.empty_table_row(b.customer.filter("customer_id < 0"), "no_customers"))
            .unionByName(Q.empty_table_row(b.customer.filter("customer_id = 1"), "one_customer")))


def dq_string_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 over the rows, on the customer sheet and on one whose names arrive as numbers."""
    raw = load_bronze(spark, sf_dir).customer
    typed = raw.withColumn("customer_name", F.col("customer_id") * 2)
    return (Q.type_violations(raw, "bronze_customer", "customer_name", ("string",))
            .unionByName(Q.type_violations(raw, "bronze_customer", "country", ("string",)))
            .unionByName(Q.type_violations(typed, "customer_typed", "customer_name", ("string",))))


def dq_date_type_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4, type side, over the rows: parsed orders against the raw ones, whose dates are strings."""
    raw = load_bronze(spark, sf_dir).orders
    dates = ("date", "timestamp", "timestamp_ntz")
    return (Q.type_violations(silver.parse_orders(raw), "silver_orders", "Order_Date", dates)
            .unionByName(Q.type_violations(raw, "bronze_orders", "Order_Date", dates)))


def dq_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 on silver tables that lack a column, or have it in another case, and on whole ones."""
    customer, products = silver_customer(spark, sf_dir), silver_products(spark, sf_dir)
    return (Q.missing_column_rows(customer, "silver_customer", Q.SILVER_CUSTOMER_COLUMNS)
            .unionByName(Q.missing_column_rows(customer.drop("country", "customer_name"), "customer_lost",
                                               Q.SILVER_CUSTOMER_COLUMNS))
            .unionByName(Q.missing_column_rows(products.withColumnRenamed("Category", "category"),
                                               "products_renamed", Q.SILVER_PRODUCT_COLUMNS)))


def dq_bad_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN and infinite profits, which the money type cannot hold."""
    rows = Q.bad_number_rows(V.orders_bad_number(load_bronze(spark, sf_dir).orders))
    return rows.select("Row_ID", "Order_ID", F.col("Profit").cast("string").alias("profit_text"))


def dq_profit_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and gold are distinct as the pipeline builds them; the raw orders are de-duplicated here."""
    L = build_layers(spark, sf_dir, store={"silver_orders": GOLD_INPUTS})
    return decimals_as_double(Q.profit_totals(L.bronze.orders, L.silver_orders, L.gold,
                                              layers_distinct=True, bronze_distinct=False))


def dq_category_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = build_layers(spark, sf_dir)
    return Q.category_counts(V.products_lost(L.silver_products), L.bronze.products)


def dq_category_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9, stronger form: the categories themselves, not only their counts."""
    L = build_layers(spark, sf_dir)
    return Q.category_value_differences(V.products_lost(L.silver_products), L.bronze.products,
                                        "Category")


def silver_orders_dup_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders against a customer table with duplicated keys (README
    D12): left joins keep every match, so the orders of such a key appear
    once per customer row.  The pk_unique check is the guard against this."""
    b = load_bronze(spark, sf_dir)
    customers = V.customers_dup_key(silver.enrich_customers(b.customer))
    return decimals_as_double(
        silver.enrich_orders(b.orders, customers, silver.enrich_products(b.products)))


def dq_gold_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.gold_grouping_violations(V.gold_dup(build_layers(spark, sf_dir).gold))


def dq_name_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = load_bronze(spark, sf_dir).customer
    return Q.name_format_rows(raw).select("customer_id", "customer_name")


def dq_null_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned customers whose name is null: the name-format check lets them
    through, and they reach gold as a null-name group (README D10)."""
    return Q.null_name_rows(silver_customer(spark, sf_dir))


def dq_year_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = V.gold_bad_year(build_layers(spark, sf_dir).gold)
    return decimals_as_double(Q.year_range_rows(g))


def dq_fk_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = build_layers(spark, sf_dir)
    return Q.missing_keys(L.silver_orders, "Customer_ID", L.silver_customer, "customer_id")


def dq_fk_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = build_layers(spark, sf_dir)
    return Q.missing_keys(L.silver_orders, "Product_ID", L.silver_products, "Product_ID")


def dq_gold_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = build_layers(spark, sf_dir, store={"silver_orders": GOLD_INPUTS, "gold": None})
    return decimals_as_double(Q.gold_mismatches(L.silver_orders, V.gold_dup(L.gold)))


def dq_gold_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = build_layers(spark, sf_dir, store={"silver_orders": GOLD_INPUTS})
    return decimals_as_double(Q.gold_total_accuracy(L.silver_orders, L.gold))


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = build_layers(spark, sf_dir, store=("silver_customer", "silver_products", "silver_orders"))
    return Q.quality_report(spark, Q.LayerFrames(
        bronze_orders=L.bronze.orders, bronze_customer=L.bronze.customer,
        bronze_products=L.bronze.products, silver_customer=L.silver_customer,
        silver_products=L.silver_products, silver_orders=L.silver_orders, gold=L.gold),
        layers_distinct=True, bronze_distinct=False)


QUERIES.update({
    "dq_pk_null": dq_pk_null,
    "dq_pk_unique": dq_pk_unique,
    "dq_date_type": dq_date_type,
    "dq_decimal_places": dq_decimal_places,
    "dq_non_empty": dq_non_empty,
    "dq_non_empty_planted": dq_non_empty_planted,
    "dq_string_type": dq_string_type,
    "dq_date_type_schema": dq_date_type_schema,
    "dq_columns": dq_columns,
    "dq_bad_number": dq_bad_number,
    "dq_profit_layers": dq_profit_layers,
    "dq_category_sets": dq_category_sets,
    "dq_category_values": dq_category_values,
    "silver_orders_dup_customers": silver_orders_dup_customers,
    "dq_gold_grouping": dq_gold_grouping,
    "dq_name_format": dq_name_format,
    "dq_null_names": dq_null_names,
    "dq_year_range": dq_year_range,
    "dq_fk_customer": dq_fk_customer,
    "dq_fk_product": dq_fk_product,
    "dq_gold_accuracy": dq_gold_accuracy,
    "dq_gold_total": dq_gold_total,
    "dq_report": dq_report,
})


# ------------------------------------------------------------ sources/sinks
# These write under the shared scratch folder (spark.checkpoint.dir) and read
# the result back, each call in its own sub-folder and schema.


# Headers as a raw products CSV carries them (spaces and hyphens).
RAW_PRODUCT_HEADERS = ("Product ID", "Category", "Sub-Category", "Product Name", "Price per product")
RAW_PRODUCT_DDL = ("`Product ID` BIGINT, Category STRING, `Sub-Category` STRING, "
                   "`Product Name` STRING, `Price per product` DOUBLE")
ORDERS_DDL = ("Row_ID BIGINT, Order_ID BIGINT, Order_Date STRING, Ship_Date STRING, Ship_Mode STRING, "
              "Customer_ID BIGINT, Product_ID BIGINT, Quantity DOUBLE, Price DOUBLE, Discount DOUBLE, "
              "Profit DECIMAL(18,4)")


def _run_names(spark: SparkSession, tag: str) -> LayerNames:
    uid = uuid.uuid4().hex[:10]
    names = LayerNames(bronze_schema=f"bronze_{tag}_{uid}", silver_schema=f"silver_{tag}_{uid}",
                       gold_schema=f"gold_{tag}_{uid}")
    for schema in (names.bronze_schema, names.silver_schema, names.gold_schema):
        scratch_schema(spark, f"{names.catalog}.{schema}")
    return names


# Records of one pretty-printed file, whatever the keys.
RECORDS_PER_FILE = 5_000
# Lines of one landed file: a compressed file is read by one task.
LINES_PER_FILE = 500_000
# Of the files that a stream takes in, each writing task leaves this many.
STREAM_PARTS = 8


def _land(rows: DataFrame, path: str, fmt: str, part: str | None = None) -> None:
    """Rows as compressed text files (JSON lines, or text as it is): plain ones take several times the given tables' disk."""
    writer = rows.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE)
    with shuffles_dropped(rows.sparkSession):
        (writer.partitionBy(part) if part else writer).format(fmt).save(path)


def _land_for_stream(rows: DataFrame, path: str, fmt: str, triggers: int) -> tuple[str, int]:
    """Rows landed as at least ``STREAM_PARTS`` files; returns the files' folders and how many files a trigger takes
    so that a stream has about ``triggers`` micro-batches.

    Every task deals its rows out over all parts, so nothing is shuffled for
    it, and files stay small however large the table is.
    """
    _land(rows.withColumn("part", F.monotonically_increasing_id() % STREAM_PARTS), path, fmt, "part")
    hadoop = rows.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/part=*/*")
    files = hadoop.getFileSystem(rows.sparkSession.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return f"{path}/part=*", max(1, -(-len(files) // triggers))


def _write_json_arrays(orders: DataFrame, path: str) -> None:
    """Many files, each one pretty-printed JSON array, as an export tool leaves them.

    A file takes consecutive rows of one partition, so no key makes a file
    large; the numbers are stored first, so that a task which runs again does
    not deal its rows out anew.
    """
    with staged(orders.sparkSession) as stage:
        numbered = stage(orders.withColumn("_file", F.expr(f"monotonically_increasing_id() div {RECORDS_PER_FILE}")))
        rows = numbered.groupBy("_file").agg(
            F.collect_list(F.to_json(F.struct(*orders.columns), {"pretty": "true"})).alias("records"))
        text = F.concat(F.lit("[\n"), F.array_join("records", ",\n"), F.lit("\n]"))
        with shuffles_dropped(orders.sparkSession):
            rows.select(text.alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 1).option(
                "compression", "gzip").text(path)


def _land_dimensions(spark: SparkSession, sf_dir: str, root: str) -> tuple[SourceSpec, SourceSpec]:
    """Products as CSV with raw headers, and customers as a landed table."""
    b = load_bronze(spark, sf_dir)
    b.products.toDF(*RAW_PRODUCT_HEADERS).write.mode("overwrite").option("header", True).csv(
        f"{root}/raw/products")
    landing = _run_names(spark, "landing")
    prepare_schemas(spark, landing, f"{root}/landing")
    landing_table = landing.bronze("customer_worksheet")
    write_table(b.customer, landing_table, dedup=False)
    return SourceSpec(f"{root}/raw/products", "csv", RAW_PRODUCT_DDL), SourceSpec(landing_table, "table")


def _land_files(spark: SparkSession, sf_dir: str, root: str, multi_line: bool = False) -> MedallionSources:
    """Write the raw inputs as the reference receives them: products CSV with
    raw headers, orders as JSON (Lines, or pretty-printed arrays), customers as
    a landed table."""
    orders = load_bronze(spark, sf_dir).orders
    if multi_line:
        _write_json_arrays(orders, f"{root}/raw/orders")
    else:
        _land(orders, f"{root}/raw/orders", "json")
    products, customer = _land_dimensions(spark, sf_dir, root)
    return MedallionSources(
        orders=SourceSpec(f"{root}/raw/orders", "json", ORDERS_DDL, {"multi_line": multi_line}),
        products=products, customer=customer)


def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = load_bronze(spark, sf_dir).products.toDF(*RAW_PRODUCT_HEADERS)
    return clean_column_names(raw)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "csv")
    load_bronze(spark, sf_dir).products.toDF(*RAW_PRODUCT_HEADERS).write.mode("overwrite") \
        .option("header", True).csv(f"{root}/products")
    return clean_column_names(read_csv(spark, f"{root}/products", schema=RAW_PRODUCT_DDL))


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "json")
    _land(load_bronze(spark, sf_dir).orders, f"{root}/orders", "json")
    return decimals_as_double(read_json(spark, f"{root}/orders", schema=ORDERS_DDL).dropDuplicates())


def table_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "tables")
    names = _run_names(spark, "copy")
    prepare_schemas(spark, names, root)
    landing = names.bronze("customer_worksheet")
    write_table(load_bronze(spark, sf_dir).customer, landing, dedup=False)
    return ingest_table(spark, landing, names.bronze(names.bronze_customer))


def dedup_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "tables")
    names = _run_names(spark, "dedup")
    prepare_schemas(spark, names, root)
    target = names.bronze(names.bronze_orders)
    write_table(V.orders_dup(load_bronze(spark, sf_dir).orders), target)
    return decimals_as_double(read_table(spark, target))


def json_multiline_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "json")
    _write_json_arrays(load_bronze(spark, sf_dir).orders, f"{root}/orders")
    return decimals_as_double(read_json(spark, f"{root}/orders", multi_line=True, schema=ORDERS_DDL).dropDuplicates())


def _run(spark: SparkSession, sf_dir: str, tag: str, multi_line: bool = False,
         checks: WriteChecks | None = None) -> tuple[LayerNames, DataFrame]:
    root = scratch_dir(spark, tag)
    sources = _land_files(spark, sf_dir, root, multi_line)
    names = _run_names(spark, tag)
    return names, run_medallion(spark, sources, names, root=root, checks=checks)


def medallion_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(_run(spark, sf_dir, "run")[1])


def medallion_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run on orders that arrive as pretty-printed JSON arrays."""
    return decimals_as_double(_run(spark, sf_dir, "pretty", multi_line=True)[1])


def medallion_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks over the tables that a run has written."""
    return check_tables(spark, _run(spark, sf_dir, "report")[0])


def medallion_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report, its row rules counted by the jobs that wrote the tables."""
    checks = WriteChecks()
    names, _ = _run(spark, sf_dir, "observed", checks=checks)
    return check_written(spark, checks, names)


def _stream_orders(spark: SparkSession, sf_dir: str, root: str, names: LayerNames, distinct: bool = False) -> DataFrame:
    """Orders, some of them twice, landed as several JSON files and ingested in several micro-batches."""
    from strata.streaming import ingest_files

    landed, files = _land_for_stream(V.orders_dup(load_bronze(spark, sf_dir).orders), f"{root}/landing", "json", triggers=4)
    prepare_schemas(spark, names, root)
    return ingest_files(spark, SourceSpec(landed, "json", ORDERS_DDL),
                        names.bronze(names.bronze_orders), f"{root}/_checkpoint", max_files_per_trigger=files, distinct=distinct)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimals_as_double(_stream_orders(spark, sf_dir, scratch_dir(spark, "stream"), _run_names(spark, "stream")))


def stream_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and gold over a streamed bronze table that leaves out copies from earlier batches on arrival."""
    root, names = scratch_dir(spark, "stream"), _run_names(spark, "streamed")
    _stream_orders(spark, sf_dir, root, names, distinct=True)
    products, customer = _land_dimensions(spark, sf_dir, f"{root}/dimensions")
    process_bronze(spark, products, names.bronze(names.bronze_products))
    ingest_table(spark, customer.path, names.bronze(names.bronze_customer))
    process_silver(spark, names)
    return decimals_as_double(process_gold(spark, names))


def silver_orders_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders with both joins salted for the keys of at least 0.1 % of the rows, and for null keys."""
    b = load_bronze(spark, sf_dir)
    return decimals_as_double(silver.enrich_orders(
        b.orders, silver.enrich_customers(b.customer), silver.enrich_products(b.products), salt_buckets=4,
        hot_key_share=0.001))


def silver_orders_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders with dimensions broadcast where they are measured to be small."""
    L = build_layers(spark, sf_dir, store=("silver_customer", "silver_products"))
    return decimals_as_double(silver.enrich_orders(
        L.bronze.orders, L.silver_customer, L.silver_products, broadcast_max_rows=1_000_000,
        dimensions_distinct=True))


QUERIES.update({
    "stream_ingest": stream_ingest,
    "stream_medallion": stream_medallion,
    "json_multiline_roundtrip": json_multiline_roundtrip,
    "medallion_multiline": medallion_multiline,
    "medallion_report": medallion_report,
    "medallion_observed": medallion_observed,
    "silver_orders_salted": silver_orders_salted,
    "silver_orders_broadcast": silver_orders_broadcast,
    "clean_names": clean_names,
    "csv_roundtrip": csv_roundtrip,
    "json_roundtrip": json_roundtrip,
    "table_copy": table_copy,
    "dedup_overwrite": dedup_overwrite,
    "medallion_run": medallion_run,
})


# ------------------------------------------------------- versioned layers


def _customer_survivors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customers = V.customers_hot_key(silver_customer(spark, sf_dir))
    return customers, survivors(customers, ("customer_id",), [F.expr(r) for r in CUSTOMER_RULES])


def silver_orders_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders against customers with repeated keys, one of them hot: one survivor a key, so no order is multiplied."""
    b = load_bronze(spark, sf_dir)
    return decimals_as_double(silver.enrich_orders(
        b.orders, _customer_survivors(spark, sf_dir)[1], silver.enrich_products(b.products), dimensions_distinct=True))


def dimension_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer rows that lost against their key's survivor, and those without a key."""
    return losing_rows(*_customer_survivors(spark, sf_dir), ("customer_id",))


class _Killed(BaseException):
    """Ends a run as a lost driver would, between two writes."""


def published_medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of two published versions. Between them a run dies after some of its
    writes; the second overwrites silver orders from itself (the even orders)."""
    root, names = scratch_dir(spark, "published"), LayerNames()
    store = LayerStore(spark, f"{root}/store")
    sources = _land_files(spark, sf_dir, root)
    publish_medallion(spark, store, sources, names)
    try:
        with store.run() as run:
            run.write(store.read("silver.silver_customer").limit(0), "silver.silver_customer")
            raise _Killed
    except _Killed:
        pass
    with store.run() as run:
        orders = run.write(run.read("silver.silver_orders").where("Order_ID % 2 = 0"), "silver.silver_orders", dedup=False)
        write_gold_groups(run, orders, "gold.profit")
    versions = [gold_of(store, names, n).withColumn("version", F.lit(n)) for n in store.versions()]
    return decimals_as_double(versions[0].unionByName(versions[1]))


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after inserted, corrected and deleted order lines, by the difference of
    two silver versions; ``rewritten`` marks the years whose files are new."""
    store = LayerStore(spark, f"{scratch_dir(spark, 'incremental')}/store")
    new = build_layers(spark, sf_dir, store={"silver_orders": None}).silver_orders
    with store.run() as run:
        write_gold_groups(run, run.write(V.orders_before(new), "silver.silver_orders", dedup=False), "gold.profit")
    with store.run() as run:
        old, now = run.read("silver.silver_orders"), run.write(new, "silver.silver_orders", dedup=False)
        years = refresh_gold_from_versions(run, "gold.profit", old, now)
    before, after = (set(store.version(n).tables["gold.profit"].parts.items()) for n in (1, 2))
    fresh = {name for name, _ in after - before}
    assert len(fresh) == len(years)
    rewritten = F.coalesce(F.concat(F.lit("Year="), F.col("Year").cast("string")).isin(sorted(fresh)), F.lit(False))
    return decimals_as_double(gold_rows(store.read("gold.profit")).withColumn("rewritten", rewritten))


def late_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders after every fifth customer and every seventh product arrived later than their orders; gold follows."""
    store = LayerStore(spark, f"{scratch_dir(spark, 'late')}/store")
    b = load_bronze(spark, sf_dir)
    customers, products = silver.enrich_customers(b.customer), silver.enrich_products(b.products)
    with store.run() as run:
        early = [run.write(customers.where("customer_id % 5 <> 0"), "silver.silver_customer", dedup=False),
                 run.write(products.where("Product_ID % 7 <> 0"), "silver.silver_products", dedup=False)]
        with staged(spark) as stage:
            orders = silver.enrich_orders(b.orders, *early, dimensions_distinct=True, stage=stage)
            orders = write_orders_and_index(run, orders)
        write_gold_groups(run, orders, "gold.profit")
    with store.run() as run:
        _, signed = resolve_late(run, customers, products)
        refresh_gold(run, "gold.profit", signed)
    return decimals_as_double(store.read("silver.silver_orders").drop(YEAR))


# ------------------------------------------------------------- quarantine

#: Planted records that do not fit: cut lines, and values of another type.
CUT_ORDER_EVERY, BAD_QUANTITY_EVERY = 17, 19
CUT_PRODUCT_EVERY, BAD_PRICE_EVERY = 13, 29


def _order_lines(orders: DataFrame) -> DataFrame:
    """Orders as JSON lines, some of which are cut or hold a word for a number."""
    k = F.col("Order_ID")
    start = F.concat(F.lit('{"Row_ID":'), F.col("Row_ID").cast("string"))
    return orders.select(
        F.when(k % CUT_ORDER_EVERY == 0, F.concat(start, F.lit(',"Order_')))
        .when(k % BAD_QUANTITY_EVERY == 0, F.concat(start, F.lit(',"Quantity":"many","Profit":"much"}')))
        .otherwise(F.to_json(F.struct(*orders.columns))).alias("value"))


def _kept_and_quarantined(rows: DataFrame, quarantine: DataFrame) -> DataFrame:
    kept = rows.select("Row_ID", "Order_ID", "Order_Date", F.col("Profit").cast("double").alias("Profit"),
                       F.lit(None).cast("string").alias("raw"), F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(quarantine.select("raw", "reason"), allowMissingColumns=True)


def quarantine_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which some lines do not fit: the bronze rows, and the quarantined records with their reasons."""
    root, names = scratch_dir(spark, "quarantine"), _run_names(spark, "quarantine")
    _land(_order_lines(load_bronze(spark, sf_dir).orders), f"{root}/orders", "text")
    prepare_schemas(spark, names, root)
    kept = names.bronze(names.bronze_orders + QUARANTINE)
    rows = process_bronze(spark, SourceSpec(f"{root}/orders", "json", ORDERS_DDL), names.bronze(names.bronze_orders),
                          quarantine_table=kept)
    return _kept_and_quarantined(rows, read_table(spark, kept))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as a file stream in several micro-batches."""
    from strata.streaming import ingest_files

    root, names = scratch_dir(spark, "quarantine"), _run_names(spark, "quarantine")
    landed, files = _land_for_stream(_order_lines(load_bronze(spark, sf_dir).orders), f"{root}/orders", "text", triggers=2)
    prepare_schemas(spark, names, root)
    kept = names.bronze(names.bronze_orders + QUARANTINE)
    rows = ingest_files(spark, SourceSpec(landed, "json", ORDERS_DDL), names.bronze(names.bronze_orders),
                        f"{root}/_checkpoint", max_files_per_trigger=files, quarantine_table=kept)
    return _kept_and_quarantined(rows, read_table(spark, kept))


def quarantine_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of which some lines have too few fields or a word for a price."""
    root = scratch_dir(spark, "quarantine")
    products = load_bronze(spark, sf_dir).products
    k = F.col("Product_ID")
    fields = [F.col(c).cast("string") for c in products.columns]
    line = (F.when(k % CUT_PRODUCT_EVERY == 0, F.concat_ws(",", *fields[:3]))
            .when(k % BAD_PRICE_EVERY == 0, F.concat_ws(",", *fields[:4], F.lit("free"))).otherwise(F.concat_ws(",", *fields)))
    products.select(line.alias("value")).write.text(f"{root}/products")
    split = read_split(spark, SourceSpec(f"{root}/products", "csv", RAW_PRODUCT_DDL, {"header": False}))
    rows = clean_column_names(split.rows).withColumns({c: F.lit(None).cast("string") for c in ("raw", "reason")})
    return rows.unionByName(split.quarantine.select("raw", "reason"), allowMissingColumns=True)


QUERIES.update({
    "quarantine_json": quarantine_json,
    "stream_quarantine": stream_quarantine,
    "quarantine_csv": quarantine_csv,
    "silver_orders_survivors": silver_orders_survivors,
    "dimension_rejects": dimension_rejects,
    "published_medallion": published_medallion,
    "gold_incremental": gold_incremental,
    "late_dimensions": late_dimensions,
})
