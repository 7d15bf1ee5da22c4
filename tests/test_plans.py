"""The plans the README promises: pruning, pushdown, no Python, few shuffles."""

import pytest

from conftest import SF_SMALL
from strata.operators import gold, silver
from strata.plans.inspect import operator_count, physical_plan, read_schemas
from strata.plans.layers import build_layers
from strata.sources.adapters import load_bronze


@pytest.fixture
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_gold_plan_prunes_columns_and_has_no_python(spark):
    plan = physical_plan(build_layers(spark, SF_SMALL).gold)
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan
    lineitem = [s for s in read_schemas(plan) if "l_orderkey" in s]
    assert lineitem and all("l_tax" not in s and "l_returnflag" not in s for s in lineitem)
    customer = [s for s in read_schemas(plan) if "c_custkey" in s]
    assert customer and all("c_acctbal" not in s for s in customer)
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan


def test_order_dedup_reuses_join_partitioning(spark, no_auto_broadcast):
    """lineitem ⋈ orders is hash-partitioned on l_orderkey (= Order_ID), so the
    full-row de-dup of the parsed orders needs no exchange of its own."""
    b = load_bronze(spark, SF_SMALL)
    plan = physical_plan(silver.parse_orders(b.orders).dropDuplicates())
    assert operator_count(plan, "SortMergeJoin") == 1
    assert operator_count(plan, "Exchange") == 2  # the two join inputs only
    assert operator_count(plan, "HashAggregate") == 2  # partial + final, no exchange between


def test_silver_joins_sort_merge_without_broadcast(spark, no_auto_broadcast):
    plan = physical_plan(build_layers(spark, SF_SMALL).silver_orders)
    assert operator_count(plan, "BroadcastHashJoin") == 0
    assert operator_count(plan, "SortMergeJoin LeftOuter") == 2


def test_small_dimensions_are_broadcast_by_size(spark):
    plan = physical_plan(build_layers(spark, SF_SMALL).silver_orders)
    assert operator_count(plan, "BroadcastHashJoin LeftOuter") == 2
    assert operator_count(plan, "SortMergeJoin Inner") == 1  # the fact-to-fact join stays merge


def test_no_post_join_dedup(spark, no_auto_broadcast):
    """De-dup happens on raw orders and dimensions only: 3 de-dups (orders,
    customers, products), each a partial+final pair, and the gold aggregate."""
    plan = physical_plan(build_layers(spark, SF_SMALL).gold)
    assert operator_count(plan, "HashAggregate") == 8


def test_report_on_gold_table_is_one_aggregate_and_sort(spark, tmp_path):
    path = str(tmp_path / "gold")
    build_layers(spark, SF_SMALL).gold.write.parquet(path)
    plan = physical_plan(gold.profit_by_year(spark.read.parquet(path)))
    (schema,) = read_schemas(plan)
    assert schema.startswith("struct<Year:int,Profit:decimal(") and schema.count(":") == 2
    assert operator_count(plan, "HashAggregate") == 2
    assert operator_count(plan, "Sort") == 1


def test_stored_distinct_dimensions_are_not_deduplicated_again(spark, tmp_path, no_auto_broadcast):
    b = load_bronze(spark, SF_SMALL)
    silver.enrich_customers(b.customer).write.parquet(str(tmp_path / "c"))
    silver.enrich_products(b.products).write.parquet(str(tmp_path / "p"))
    cust, prod = spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "p"))
    default = physical_plan(silver.enrich_orders(b.orders, cust, prod))
    trusted = silver.enrich_orders(b.orders, cust, prod, dimensions_distinct=True)
    plan = physical_plan(trusted)
    assert operator_count(default, "HashAggregate") == 6  # orders, customers, products
    assert operator_count(plan, "HashAggregate") == 2  # the orders de-dup only
    assert trusted.exceptAll(silver.enrich_orders(b.orders, cust, prod)).isEmpty()


def test_shuffle_counts_do_not_grow(spark, no_auto_broadcast):
    """The large-scale shape (no dimension broadcast), from the raw tables:
    2 shuffles join lineitem to orders (the order de-dup reuses them), 2 join
    customer to nation, 2 de-dup the dimensions, 4 feed the two dimension
    joins; gold adds 1."""
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
    from plan_shapes import shape

    import __spark_entry__ as E

    assert shape(physical_plan(E.queries()["silver_orders"](spark, SF_SMALL)))["shuffles"] == 10
    assert shape(physical_plan(E.queries()["gold_profit"](spark, SF_SMALL)))["shuffles"] == 11


def _stored_layers(spark, tmp_path):
    from strata.operators.quality import LayerFrames

    L = build_layers(spark, SF_SMALL)
    frames = dict(bronze_orders=L.bronze.orders, bronze_customer=L.bronze.customer, bronze_products=L.bronze.products,
                  silver_customer=L.silver_customer, silver_products=L.silver_products,
                  silver_orders=L.silver_orders, gold=L.gold)
    for name, df in frames.items():
        df.write.parquet(str(tmp_path / name))
    return LayerFrames(**{name: spark.read.parquet(str(tmp_path / name)) for name in frames})


def test_report_scans_each_stored_layer_once_per_purpose(spark, tmp_path):
    from strata.operators.quality import profit_totals, quality_report

    t = _stored_layers(spark, tmp_path)
    plan = physical_plan(quality_report(spark, t, layers_distinct=True))
    assert operator_count(plan, "Scan parquet") == 10
    totals = physical_plan(profit_totals(t.bronze_orders, t.silver_orders, t.gold, layers_distinct=True))
    assert "hashpartitioning" not in totals  # partial sums only: no row is dealt out
    # bronze: its four columns at most; gold is the only layer read in full
    assert all("Ship_Mode" not in s for s in read_schemas(plan))


def test_gold_checks_store_only_what_they_read(spark):
    from strata.plans.layers import GOLD_INPUTS

    L = build_layers(spark, SF_SMALL, store={"silver_orders": GOLD_INPUTS})
    assert L.silver_orders.columns == list(GOLD_INPUTS)
    with pytest.raises(ValueError, match="cannot store"):
        build_layers(spark, SF_SMALL, store={"silver": None})


def test_non_empty_probe_has_no_dimension_join_or_dedup(spark):
    import __spark_entry__ as E

    plan = physical_plan(E.queries()["dq_non_empty"](spark, SF_SMALL))
    assert "LeftOuter" not in plan
