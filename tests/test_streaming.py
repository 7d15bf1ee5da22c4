import json
import tempfile

import pytest

from strata.plans.pipeline import (
    check_tables,
    prepare_schemas,
    process_bronze,
    process_gold,
    process_silver,
    read_bronze,
)
from strata.session import scratch_dir
from strata.settings import LayerNames, SourceSpec
from strata.streaming import INGEST_BATCH_COLUMN, ingest_files
from strata.streaming.ingest import _batch_writer

DDL = "`Order ID` BIGINT, `Sub-Category` STRING, Profit DOUBLE"


def _names(tag):
    return LayerNames(bronze_schema=f"bronze_stream_{tag}", silver_schema=f"silver_stream_{tag}",
                      gold_schema=f"gold_stream_{tag}")


def test_incremental_runs_pick_up_only_new_files(spark):
    root = scratch_dir(spark, "t-stream")
    names = _names("incr")
    prepare_schemas(spark, names, root)
    table = names.bronze("orders")
    src = SourceSpec(f"{root}/landing", "csv", DDL)
    spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (2, "b", 2.0)], DDL) \
        .coalesce(1).write.option("header", True).csv(f"{root}/landing", mode="append")
    out = ingest_files(spark, src, table, f"{root}/ckpt")
    assert out.columns == ["Order_ID", "Sub_Category", "Profit"]
    assert out.count() == 2
    spark.createDataFrame([(3, "c", 3.0), (2, "b", 2.0)], DDL) \
        .coalesce(1).write.option("header", True).csv(f"{root}/landing", mode="append")
    out = ingest_files(spark, src, table, f"{root}/ckpt")
    assert out.count() == 3
    stored = spark.table(table)
    assert stored.columns[-1] == INGEST_BATCH_COLUMN
    assert stored.count() == 4  # only the new file was read; its copy of order 2 is stored, not seen
    assert ingest_files(spark, src, table, f"{root}/ckpt").count() == 3  # nothing new


def test_replayed_batch_replaces_its_own_partition(spark):
    root = scratch_dir(spark, "t-stream")
    names = _names("replay")
    prepare_schemas(spark, names, root)
    table = names.bronze("orders")
    write = _batch_writer(table, "parquet")
    batch = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], DDL)
    write(batch, 0)
    write(spark.createDataFrame([(3, "c", 3.0)], DDL), 1)
    write(batch, 0)  # retry of batch 0
    assert spark.table(table).count() == 3


def test_batches_are_stored_by_name(spark):
    root = scratch_dir(spark, "t-stream")
    names = _names("swap")
    prepare_schemas(spark, names, root)
    write = _batch_writer(names.bronze("orders"), "parquet")
    write(spark.createDataFrame([(1, 20.0, 0.25)], "id long, Price double, Discount double"), 0)
    write(spark.createDataFrame([(2, 0.5, 30.0)], "id long, Discount double, Price double"), 1)
    rows = {r["id"]: (r["Price"], r["Discount"]) for r in spark.table(names.bronze("orders")).collect()}
    assert rows == {1: (20.0, 0.25), 2: (30.0, 0.5)}
    for ddl in ("id long, Price double", "id long, Price double, Discount string",
                "id long, Price double, Discount double, more int"):
        with pytest.raises(ValueError, match="does not fit"):
            write(spark.createDataFrame([], ddl), 2)


def test_files_of_a_lost_first_batch_do_not_stand_in_the_way(spark):
    root = scratch_dir(spark, "t-stream")
    names = _names("left")
    prepare_schemas(spark, names, root)
    table = names.bronze("orders")
    folder = f"{root}/{names.bronze_schema}.db/orders"
    spark.createDataFrame([(9, "z", 9.0)], "Order_ID long, Sub_Category string, Profit double") \
        .write.parquet(f"{folder}/{INGEST_BATCH_COLUMN}=0")
    write = _batch_writer(table, "parquet")
    batch = spark.createDataFrame([(1, "a", 1.0)], DDL)
    write(batch, 0)
    write(batch, 1)
    rows = [tuple(r) for r in spark.table(table).select("Order_ID", INGEST_BATCH_COLUMN).collect()]
    assert sorted(rows) == [(1, 0), (1, 1)]


ORDERS = ("Row_ID BIGINT, Order_ID BIGINT, Order_Date STRING, Ship_Date STRING, Ship_Mode STRING, Customer_ID BIGINT, "
          "Product_ID BIGINT, Quantity DOUBLE, Price DOUBLE, Discount DOUBLE, Profit DECIMAL(18,4)")


@pytest.mark.parametrize("files", [1, 2, None])
def test_streamed_bronze_gives_the_batch_layers(spark, files):
    """Copies in different files: silver, gold and the report are those of the batch run."""
    landing = tempfile.mkdtemp(prefix="t-landing-")
    rows = [{"Row_ID": k, "Order_ID": k, "Order_Date": "n/a" if k == 3 else "3/1/2016", "Ship_Date": "4/1/2016", "Ship_Mode": "O",
             "Customer_ID": 1, "Product_ID": 7, "Quantity": 1.0, "Price": 9.5, "Discount": 0.0, "Profit": 5.125} for k in range(1, 6)]
    for n, part in enumerate((rows[:3], rows[2:], rows[:2], rows)):
        with open(f"{landing}/{n}.json", "w") as f:
            f.write("".join(json.dumps(r) + "\n" for r in part))
    results = []
    for kind in ("batch", "stream"):
        root = scratch_dir(spark, "t-stream")
        names = _names(f"{kind}_{files}")
        prepare_schemas(spark, names, root)
        source = SourceSpec(landing, "json", ORDERS)
        if kind == "batch":
            process_bronze(spark, source, names.bronze(names.bronze_orders))
        else:
            ingest_files(spark, source, names.bronze(names.bronze_orders), f"{root}/ckpt", max_files_per_trigger=files)
        spark.createDataFrame([(1, "Ann 1", "a@x", "DE")], "customer_id long, customer_name string, email string, country string") \
            .write.saveAsTable(names.bronze(names.bronze_customer))
        spark.createDataFrame([(7, "C", "S")], "Product_ID long, Category string, Sub_Category string") \
            .write.saveAsTable(names.bronze(names.bronze_products))
        orders = process_silver(spark, names).orders
        gold = process_gold(spark, names)
        results.append([sorted(map(str, df.collect())) for df in (
            read_bronze(spark, names, names.bronze_orders), orders, gold, check_tables(spark, names))])
        assert orders.columns[:1] == ["Product_ID"] and INGEST_BATCH_COLUMN not in orders.columns
    assert results[0] == results[1]
    assert len(results[0][1]) == 5


def test_stream_needs_a_schema_and_a_file_format(spark):
    root = scratch_dir(spark, "t-stream")
    with pytest.raises(ValueError, match="schema"):
        ingest_files(spark, SourceSpec(f"{root}/x", "csv"), "t", f"{root}/ckpt")
    with pytest.raises(ValueError, match="Invalid source file type"):
        ingest_files(spark, SourceSpec(f"{root}/x", "xlsx", DDL), "t", f"{root}/ckpt")


@pytest.mark.parametrize("per_trigger", [1, None])
def test_distinct_on_arrival(spark, per_trigger):
    """Copies from other batches are not stored; readers need no de-duplication."""
    root, tag = scratch_dir(spark, "t-stream"), f"distinct{per_trigger}"
    names = _names(tag)
    prepare_schemas(spark, names, root)
    table, src = names.bronze("orders"), SourceSpec(f"{root}/landing", "csv", DDL)
    rows = [[(1, "a", 1.0), (1, "a", 1.0), (2, None, 2.0)], [(2, None, 2.0), (2, "b", None), (None, "b", 2.0)], [(1, "a", 1.0), (3, "c", 0.0), (3, "c", -0.0)]]
    for part in rows:
        spark.createDataFrame(part, DDL).coalesce(1).write.option("header", True).csv(f"{root}/landing", mode="append")
    out = ingest_files(spark, src, table, f"{root}/ckpt", max_files_per_trigger=per_trigger, distinct=True)
    want = sorted({x for part in rows for x in part}, key=repr)
    assert sorted(map(tuple, out.collect()), key=repr) in (want, [w for w in want if repr(w) != repr((3, "c", -0.0))])
    assert out.columns == ["Order_ID", "Sub_Category", "Profit"]
    assert spark.table(table).count() == out.count() == spark.table(table + "_seen").count() == 5
    assert "Aggregate" not in read_bronze(spark, names, "orders")._jdf.queryExecution().optimizedPlan().toString()
    spark.createDataFrame([(1, "a", 1.0), (9, "z", 1.0)], DDL).coalesce(1).write.option("header", True).csv(f"{root}/landing", mode="append")
    assert ingest_files(spark, src, table, f"{root}/ckpt", distinct=True).count() == 6


def test_a_batch_that_runs_again_stores_the_same_rows(spark):
    """Whichever of its two writes was the last to succeed."""
    names = _names("distinct_replay")
    prepare_schemas(spark, names, scratch_dir(spark, "t-stream"))
    table = names.bronze("orders")
    write = _batch_writer(table, "parquet", distinct=True)
    first, second = (spark.createDataFrame(x, DDL) for x in ([(1, "a", 1.0), (2, "b", 2.0)], [(2, "b", 2.0), (3, "c", 3.0)]))
    write(first, 0)
    write(second, 1)
    write(second, 1)
    spark.sql(f"ALTER TABLE {table}_seen DROP PARTITION ({INGEST_BATCH_COLUMN} = 1)")  # died between the two writes
    write(second, 1)
    assert sorted(r[0] for r in spark.table(table).collect()) == [1, 2, 3] and spark.table(table + "_seen").count() == 3


def test_arrival_moves_rows_once_and_no_history(spark):
    """The full-width rows have one exchange; the bucketed digests have none."""
    from strata.streaming.ingest import DIGEST, _seen_table, with_digest

    names = _names("distinct_plan")
    prepare_schemas(spark, names, scratch_dir(spark, "t-stream"))
    _batch_writer(names.bronze("o"), "parquet", distinct=True)(spark.createDataFrame([(1, "a", 1.0)], DDL), 0)
    seen, buckets = _seen_table(spark, names.bronze("o"), "parquet")
    rows = spark.createDataFrame([(1, "a", 1.0)], DDL)
    batch = with_digest(rows).repartition(buckets, *DIGEST).dropDuplicates(list(DIGEST))
    earlier = spark.table(seen).where(f"{INGEST_BATCH_COLUMN} != 1").select(*DIGEST)
    plan = batch.join(earlier.hint("shuffle_hash"), list(DIGEST), "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Bucketed: true" in plan
