"""Bronze -> silver -> gold runs that write catalogue tables.

Each layer is written as a table and the next layer reads that table back:
the written table cuts the lineage (a lost executor recomputes from the
stored layer, not from the raw files) and lets each layer be re-run alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.gold import gold_profit
from strata.operators.joins import DEFAULT_MAX_BROADCAST_BYTES
from strata.operators.naming import clean_column_names
from strata.operators.observed import WriteChecks, observed_report
from strata.operators.quality import LayerFrames, quality_report
from strata.operators.silver import enrich_customers, enrich_orders, enrich_products
from strata.operators.survivorship import losing_rows, survivors
from strata.plans.incremental import gold_rows, refresh_gold_from_versions, write_gold_groups
from strata.plans.publish import LayerStore, Run
from strata.settings import LayerNames, SourceSpec
from strata.sources.quarantine import read_split
from strata.sources.readers import read_source, read_table
from strata.sources.sinks import Watch, ensure_schema, require_rows, staged, write_table
from strata.streaming.ingest import bronze_rows


def prepare_schemas(spark: SparkSession, names: LayerNames, root: str | None = None) -> None:
    for schema in (names.bronze_schema, names.silver_schema, names.gold_schema):
        ensure_schema(spark, names.catalog, schema, f"{root}/{schema}.db" if root else None)


def read_bronze(spark: SparkSession, names: LayerNames, table: str, distinct: bool = True) -> DataFrame:
    """A bronze table as silver and the checks read it, whether a batch or a stream wrote it."""
    return bronze_rows(read_table(spark, names.bronze(table)), distinct)


def process_bronze(spark: SparkSession, source: SourceSpec, target_table: str,
                   fmt: str = "parquet", quarantine_table: str | None = None,
                   watch: Watch | None = None, **read_options) -> DataFrame:
    """Read a raw source, normalise its column names, de-dup-overwrite the bronze table.

    With ``quarantine_table`` records that do not fit the declared schema are
    written there, every one of them, with their file and reason, and the rest
    lands as usual.  Returns the bronze table as written.  Write errors propagate.
    """
    if quarantine_table:
        split = read_split(spark, replace(source, options={**source.options, **read_options}))
        write_table(split.quarantine, quarantine_table, fmt, dedup=False)
        write_table(clean_column_names(split.rows), target_table, fmt, watch=watch)
        split.release()
    else:
        write_table(clean_column_names(read_source(spark, source, **read_options)), target_table, fmt, watch=watch)
    return read_table(spark, target_table)


def ingest_table(spark: SparkSession, source_table: str, target_table: str,
                 fmt: str = "parquet") -> DataFrame:
    """Copy an already-landed catalogue table into bronze (names kept as they are)."""
    write_table(read_table(spark, source_table), target_table, fmt)
    return read_table(spark, target_table)


@dataclass(frozen=True)
class SilverTables:
    customer: DataFrame
    products: DataFrame
    orders: DataFrame


#: Suffix of the table that keeps a dimension's rows which lost against its survivors.
REJECTED = "_rejected"

#: Of the rows of one customer, one with a name comes first, then one with a country.
CUSTOMER_RULES = ("customer_name IS NOT NULL", "country IS NOT NULL")
PRODUCT_RULES = ("Category IS NOT NULL", "Sub_Category IS NOT NULL")


def write_silver(customer: DataFrame, orders: DataFrame, products: DataFrame, names: LayerNames,
                 write: Callable[[DataFrame, str], DataFrame], email_fallback: bool = False,
                 broadcast_max_rows: int | None = None,
                 broadcast_max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                 salt_buckets: int = 0, unique_keys: bool = False,
                 customer_rules: Sequence[str] = CUSTOMER_RULES,
                 product_rules: Sequence[str] = PRODUCT_RULES) -> SilverTables:
    """The three silver tables from bronze frames; ``write(df, table)`` stores one and returns it as stored.

    The non-empty guard runs on the bronze inputs, reading one row of each.
    It also covers the silver outputs: projection, de-duplication and left
    joins never turn a non-empty input empty, so no silver plan has to be
    run twice just to be counted.

    ``unique_keys=True`` keeps one row per dimension key by the rules
    (``operators.survivorship``; SQL expressions, larger wins) and the other
    rows in a ``_rejected`` table each, so no order is multiplied by a key that
    stands twice.  Rows with a null key join nothing; they are rejected too.
    """
    require_rows({names.bronze_customer: customer, names.bronze_orders: orders,
                  names.bronze_products: products}, "bronze tables")
    sc = enrich_customers(customer, email_fallback=email_fallback)
    sp = enrich_products(products)
    # Orders join the *written* dimensions, so the dimension plans are not recomputed.
    if unique_keys:
        sc_t = _write_unique(sc, "customer_id", customer_rules, names.silver_customer, write)
        sp_t = _write_unique(sp, "Product_ID", product_rules, names.silver_products, write)
    else:
        sc_t, sp_t = write(sc, names.silver_customer), write(sp, names.silver_products)
    # The dimension tables were just written from enrich_customers /
    # enrich_products, so they are distinct: no second de-dup shuffle.
    with staged(orders.sparkSession) as stage:
        so = enrich_orders(orders, sc_t, sp_t, broadcast_max_rows=broadcast_max_rows,
                           broadcast_max_bytes=broadcast_max_bytes, dimensions_distinct=True,
                           salt_buckets=salt_buckets, stage=stage)
        return SilverTables(customer=sc_t, products=sp_t, orders=write(so, names.silver_orders))


def _write_unique(df: DataFrame, key: str, rules: Sequence[str], table: str,
                  write: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    winners = write(survivors(df, (key,), [F.expr(r) for r in rules]), table)
    write(losing_rows(df, winners, (key,)), table + REJECTED)
    return winners


def process_silver(spark: SparkSession, names: LayerNames = LayerNames(), fmt: str = "parquet",
                   checks: WriteChecks | None = None, **options) -> SilverTables:
    """Build and write the three silver catalogue tables from the bronze tables (options of ``write_silver``).

    Orders are read as they are stored: of a streamed bronze table, copies from
    different batches go in the de-duplication that follows the date parse.
    """
    layers = {names.silver_customer: "silver_customer", names.silver_products: "silver_products",
              names.silver_orders: "silver_orders"}

    def write(df: DataFrame, table: str) -> DataFrame:
        watch = checks.watch(layers[table]) if checks and table in layers else None
        write_table(df, names.silver(table), fmt, dedup=False, watch=watch)
        return read_table(spark, names.silver(table))

    return write_silver(read_bronze(spark, names, names.bronze_customer),
                        read_bronze(spark, names, names.bronze_orders, distinct=False),
                        read_bronze(spark, names, names.bronze_products), names, write, **options)


def process_gold(spark: SparkSession, names: LayerNames = LayerNames(), fmt: str = "parquet",
                 partition_by: tuple[str, ...] | None = None, watch: Watch | None = None) -> DataFrame:
    """Aggregate the silver orders table into the gold profit table
    (optionally partitioned, e.g. by Year, for partition pruning)."""
    silver_orders = read_table(spark, names.silver(names.silver_orders))
    target = names.gold(names.gold_profit)
    write_table(gold_profit(silver_orders), target, fmt, dedup=False, partition_by=partition_by, watch=watch)
    return read_table(spark, target)


@dataclass(frozen=True)
class MedallionSources:
    orders: SourceSpec
    products: SourceSpec
    customer: SourceSpec


def run_medallion(spark: SparkSession, sources: MedallionSources,
                  names: LayerNames = LayerNames(), fmt: str = "parquet",
                  root: str | None = None,
                  gold_partition_by: tuple[str, ...] | None = None,
                  salt_buckets: int = 0, checks: WriteChecks | None = None) -> DataFrame:
    """All three layers; returns the gold table.

    ``gold_partition_by=("Year",)`` lays gold out by year, so a report or
    query that filters on Year reads only the matching folders.
    ``salt_buckets=N`` salts the silver joins for hot keys (see
    ``silver.enrich_orders``).  ``checks`` counts the row rules while the
    layers are written; ``check_written`` makes the report from them.
    """
    prepare_schemas(spark, names, root)
    process_bronze(spark, sources.products, names.bronze(names.bronze_products), fmt)
    process_bronze(spark, sources.orders, names.bronze(names.bronze_orders), fmt,
                   watch=checks.watch("bronze_orders") if checks else None)
    if sources.customer.kind.lower() == "table":
        ingest_table(spark, sources.customer.path, names.bronze(names.bronze_customer), fmt)
    else:
        process_bronze(spark, sources.customer, names.bronze(names.bronze_customer), fmt)
    process_silver(spark, names, fmt, checks=checks, salt_buckets=salt_buckets)
    return process_gold(spark, names, fmt, partition_by=gold_partition_by, watch=checks.watch("gold") if checks else None)


# ------------------------------------------------------------ versioned runs

#: Suffix of a bronze table's quarantined records.
QUARANTINE = "_quarantine"


def _stage_bronze_and_silver(spark: SparkSession, run: Run, sources: MedallionSources, names: LayerNames,
                             quarantine: bool = False, **options) -> None:
    bronze = {}
    for source, table in ((sources.products, names.bronze_products), (sources.orders, names.bronze_orders),
                          (sources.customer, names.bronze_customer)):
        if quarantine and source.kind.lower() != "table":
            split = read_split(spark, source)
            run.write(split.quarantine, f"{names.bronze_schema}.{table}{QUARANTINE}", dedup=False)
            bronze[table] = run.write(clean_column_names(split.rows), f"{names.bronze_schema}.{table}")
            split.release()
        else:
            df = read_source(spark, source)
            df = df if source.kind.lower() == "table" else clean_column_names(df)
            bronze[table] = run.write(df, f"{names.bronze_schema}.{table}")

    def write(df: DataFrame, table: str) -> DataFrame:
        return run.write(df, f"{names.silver_schema}.{table}", dedup=False)

    write_silver(bronze[names.bronze_customer], bronze[names.bronze_orders], bronze[names.bronze_products],
                 names, write, **options)


def stage_medallion(spark: SparkSession, run: Run, sources: MedallionSources,
                    names: LayerNames = LayerNames(), **options) -> None:
    """All three layers into a run of a store; nothing of it is seen before the run publishes.

    Tables are named schema.table.  Gold keeps its line counts (``gold_of``
    leaves them out) and is partitioned by Year, so that ``refresh_medallion``
    can follow silver.  ``quarantine=True`` keeps records that do not fit their
    schemas in a ``_quarantine`` table each; other options are ``write_silver``'s.
    """
    _stage_bronze_and_silver(spark, run, sources, names, **options)
    write_gold_groups(run, run.read(f"{names.silver_schema}.{names.silver_orders}"),
                      f"{names.gold_schema}.{names.gold_profit}")


def _guarded(run: Run) -> list[str]:
    """The staged tables that must not be empty."""
    return [t for t in run.staged if not t.endswith((REJECTED, QUARANTINE))]


def publish_medallion(spark: SparkSession, store: LayerStore, sources: MedallionSources,
                      names: LayerNames = LayerNames(), **options) -> int:
    """A whole run: readers of the store see all its tables change at once, or none.  Returns the version."""
    run = store.begin()
    try:
        stage_medallion(spark, run, sources, names, **options)
        return run.publish(non_empty=_guarded(run))
    except BaseException:
        run.abandon()
        raise


def refresh_medallion(spark: SparkSession, store: LayerStore, sources: MedallionSources,
                      names: LayerNames = LayerNames(), **options) -> tuple[int, list]:
    """Bronze and silver from new sources, and gold by the difference of the two silver versions.

    Only the years whose groups change are written again; returns the new
    version and those years.
    """
    orders = f"{names.silver_schema}.{names.silver_orders}"
    run = store.begin()
    try:
        old = run.read(orders)
        _stage_bronze_and_silver(spark, run, sources, names, **options)
        years = refresh_gold_from_versions(run, f"{names.gold_schema}.{names.gold_profit}", old, run.read(orders))
        return run.publish(non_empty=_guarded(run)), years
    except BaseException:
        run.abandon()
        raise


def gold_of(store: LayerStore, names: LayerNames = LayerNames(), number: int | None = None) -> DataFrame:
    """The gold table of a version of the store, as ``operators.gold`` defines it."""
    return gold_rows(store.read(f"{names.gold_schema}.{names.gold_profit}", number))


def layer_tables(spark: SparkSession, names: LayerNames = LayerNames()) -> LayerFrames:
    """The seven written layer tables, as the quality checks take them."""
    return LayerFrames(
        bronze_orders=read_bronze(spark, names, names.bronze_orders),
        bronze_customer=read_bronze(spark, names, names.bronze_customer),
        bronze_products=read_bronze(spark, names, names.bronze_products),
        silver_customer=read_table(spark, names.silver(names.silver_customer)),
        silver_products=read_table(spark, names.silver(names.silver_products)),
        silver_orders=read_table(spark, names.silver(names.silver_orders)),
        gold=read_table(spark, names.gold(names.gold_profit)))


def check_tables(spark: SparkSession, names: LayerNames = LayerNames()) -> DataFrame:
    """All checks over the written layers (one report DataFrame, lazily).

    Every layer is a stored table here, so each check scans a table and no
    layer is recomputed, however many checks read it.  This library's writers
    store distinct rows, so the profit totals need no de-duplication.
    """
    return quality_report(spark, layer_tables(spark, names), layers_distinct=True)


def check_written(spark: SparkSession, checks: WriteChecks, names: LayerNames = LayerNames()) -> DataFrame:
    """The report of ``check_tables`` for tables written under ``checks``: seven scans instead of ten."""
    return observed_report(spark, layer_tables(spark, names), checks)
