"""Scale helpers and the de-dup rewrite, checked against the naive form."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import silver
from strata.operators.joins import broadcast_if_bounded
from strata.plans.inspect import operator_count, physical_plan
from strata.session import scale_conf


def test_broadcast_only_under_counted_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(100).withColumnRenamed("id", "k")
        dim = spark.range(10).withColumnRenamed("id", "k")
        small = physical_plan(fact.join(broadcast_if_bounded(dim, 10), "k", "left"))
        assert operator_count(small, "BroadcastHashJoin") == 1
        big = physical_plan(fact.join(broadcast_if_bounded(dim, 9), "k", "left"))
        assert operator_count(big, "BroadcastHashJoin") == 0
        assert operator_count(big, "SortMergeJoin") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scale_conf_sizes_partitions():
    conf = scale_conf(30 * 10**12, cores=8000)
    assert conf["spark.sql.shuffle.partitions"] == "223518"  # no cap unless the caller sets one
    capped = scale_conf(30 * 10**12, cores=8000, max_partitions=65_536)
    assert capped["spark.sql.shuffle.partitions"] == "65536"
    assert scale_conf(2 * 10**12, cores=1000)["spark.sql.shuffle.partitions"] == str(-(-2 * 10**12 // (128 << 20)))
    assert scale_conf(10**12, cores=40000)["spark.sql.shuffle.partitions"] == "120000"  # 3 per core
    assert scale_conf(10**6, cores=8)["spark.sql.shuffle.partitions"] == "24"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"


ORD = ("Row_ID bigint, Order_ID bigint, Order_Date string, Ship_Date string, Ship_Mode string, "
       "Customer_ID bigint, Product_ID bigint, Quantity double, Price double, Discount double, "
       "Profit double")
CUST = "customer_id bigint, customer_name string, country string"
PROD = "Product_ID bigint, Category string, Sub_Category string"

keys = st.one_of(st.none(), st.integers(0, 3))
order_rows = st.lists(st.tuples(
    st.integers(0, 2), st.integers(0, 2), st.sampled_from(["1/1/2020", "01/01/2020", "n/a", None]),
    st.just("s"), st.just("m"), keys, keys, st.just(1.0), st.just(2.0), st.just(0.0),
    st.sampled_from([1.0, 1.004, 1.006, -2.5])), max_size=12)
cust_rows = st.lists(st.tuples(keys, st.sampled_from(["Ann", "A1nn", None]), st.sampled_from(["X", "Y"])),
                     max_size=5)
prod_rows = st.lists(st.tuples(keys, st.sampled_from(["C", "D"]), st.sampled_from(["S", "T"])), max_size=5)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(order_rows, cust_rows, prod_rows)
def test_dedup_before_join_equals_dedup_after_join(spark, o, c, p):
    orders = spark.createDataFrame(o, ORD)
    cust = silver.enrich_customers(spark.createDataFrame(c, CUST))
    prod = silver.enrich_products(spark.createDataFrame(p, PROD))
    ours = silver.enrich_orders(orders, cust, prod)
    naive = silver.join_dimensions(silver.parse_orders(orders), cust, prod).dropDuplicates()
    assert ours.count() == naive.count()
    assert ours.exceptAll(naive).count() == 0 and naive.exceptAll(ours).count() == 0


def test_broadcast_refused_over_byte_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(100).withColumnRenamed("id", "k")
        dim = spark.range(10).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("s"))
        # 10 rows of ~1 KB each: under a 64 KB bound, over a 4 KB one
        ok = physical_plan(fact.join(broadcast_if_bounded(dim, 10, max_bytes=64 << 10), "k", "left"))
        assert operator_count(ok, "BroadcastHashJoin") == 1
        big = physical_plan(fact.join(broadcast_if_bounded(dim, 10, max_bytes=4 << 10), "k", "left"))
        assert operator_count(big, "BroadcastHashJoin") == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_row_bytes_counts_strings_and_slots(spark):
    from strata.operators.joins import _row_bytes

    df = spark.createDataFrame([(1, "abcdefghij"), (2, None)], "k bigint, s string")
    # bitmap word + 2 slots = 24 bytes a row; "abcdefghij" pads to 16 bytes
    assert df.agg(F.sum(_row_bytes(df.schema))).first()[0] == 24 + 16 + 24


def test_scale_conf_lets_aqe_split_hot_keys_behind_an_aggregation():
    assert scale_conf(10**12, cores=800)["spark.sql.adaptive.forceOptimizeSkewedJoin"] == "true"


def test_scale_conf_keys_are_session_settings(spark):
    """Spark accepts unknown keys silently, so check each is a real,
    session-modifiable SQL setting (a typo would be ignored at run time)."""
    for key in scale_conf(10**12, cores=800):
        assert spark.conf.isModifiable(key), key


small_keys = st.one_of(st.none(), st.integers(0, 4))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(small_keys, st.integers(0, 3)), max_size=15),
       st.lists(st.tuples(small_keys, st.sampled_from(["x", "y"])), max_size=6),
       st.lists(st.integers(0, 5), max_size=3, unique=True),
       st.integers(1, 5))
def test_salted_join_equals_plain_join_property(spark, fact_rows, dim_rows, hot, buckets):
    from strata.operators.joins import salted_left_join

    fact = spark.createDataFrame(fact_rows, "k bigint, v int")
    dim = spark.createDataFrame(dim_rows, "k bigint, d string")
    plain = fact.join(dim, "k", "left")
    salted = salted_left_join(fact, dim, "k", hot, buckets)
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()
