"""What queries and writers leave on disk: compressed landings, no shuffle files of finished writes, no copies of stored steps."""

import os
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from strata import session
from strata.operators import late, silver
from strata.plans import catalog, pipeline
from strata.plans import late as late_plan
from strata.plans.publish import LayerStore
from strata.session import SHUFFLE_CLEANUP, release_folder, scratch_dir, shuffles_dropped
from strata.settings import LayerNames, SourceSpec
from strata.sources import quarantine, sinks
from strata.sources.sinks import staged, write_table
from strata.streaming import INGEST_BATCH_COLUMN
from tests.conftest import SF_SMALL


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(folder, *ends):
    folder = folder.removeprefix("file:")
    return [f for _, _, names in os.walk(folder) for f in names if f.startswith("part-") and f.endswith(ends)]


@pytest.fixture
def folders(spark, monkeypatch):
    """Scratch folders by purpose, as they are asked for."""
    made = {}
    ask = session.scratch_dir

    def remembered(spark, purpose="scratch"):
        made.setdefault(purpose, []).append(path := ask(spark, purpose))
        return path

    for module in (session, sinks, quarantine, catalog):
        monkeypatch.setattr(module, "scratch_dir", remembered)
    return made


@pytest.fixture
def steps(monkeypatch):
    """How often a plan is stored on its way, by block."""
    counts = []

    @contextmanager
    def counted(spark):
        counts.append(0)
        mine = len(counts) - 1
        with sinks_staged(spark) as stage:
            def step(df):
                counts[mine] += 1
                return stage(df)
            yield step

    sinks_staged = staged
    for module in (pipeline, late_plan, catalog):
        monkeypatch.setattr(module, "staged", counted)
    return counts


def gone(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def test_writes_run_with_shuffle_cleanup_and_the_setting_is_put_back(spark):
    assert spark.conf.isModifiable(SHUFFLE_CLEANUP)
    for own in ("false", "true"):
        spark.conf.set(SHUFFLE_CLEANUP, own)
        with pytest.raises(KeyError), shuffles_dropped(spark):
            assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
            raise KeyError
        assert spark.conf.get(SHUFFLE_CLEANUP) == own
    spark.conf.unset(SHUFFLE_CLEANUP)


def test_every_writer_asks_for_the_cleanup(spark, monkeypatch):
    seen = []

    @contextmanager
    def asked(spark):
        seen.append(1)
        with shuffles_dropped(spark):
            yield

    from strata.plans import publish
    for module in (sinks, quarantine, catalog, publish):
        monkeypatch.setattr(module, "shuffles_dropped", asked)
    df, root = spark.createDataFrame([(1, "a")], "id int, s string"), scratch_dir(spark, "t-asked")
    write_table(df, "default.t_disk_asked")
    sinks.materialize(df)
    catalog._land(df, f"{root}/json", "json")
    with LayerStore(spark, f"{root}/store").run() as run:
        run.write(df, "a.b")
    assert len(seen) == 4
    spark.sql("DROP TABLE default.t_disk_asked")


def test_stages_keep_the_rows_and_only_the_last_copy(spark, folders):
    df = spark.createDataFrame([(1, "a"), (None, None), (1, "a")], "id int, s string")
    with staged(spark) as stage:
        first = stage(df)
        assert content(first) == content(df)
        second = stage(first.withColumn("n", F.lit(1)))
        assert [gone(spark, f) for f in folders["stage"]] == [True, False]
        assert content(second.drop("n")) == content(df) and second.columns == ["id", "s", "n"]
    assert all(gone(spark, f) for f in folders["stage"])


def test_a_failing_block_leaves_no_copy_and_a_folder_is_released_once(spark, folders):
    with pytest.raises(ZeroDivisionError), staged(spark) as stage:
        stage(spark.range(3))
        1 / 0
    assert gone(spark, folders["stage"][0])
    path = scratch_dir(spark, "t-release")
    spark.range(2).write.parquet(path)
    release_folder(spark, path)
    assert gone(spark, path) and ("folder", path) not in session._STORED[spark.sparkContext.applicationId]


def test_staged_silver_equals_the_single_plan(spark):
    orders = spark.createDataFrame(
        [(1, 1, "1/2/1995", "m", 1, 1, 1.004), (1, 1, "1/2/1995", "m", 1, 1, 1.0), (2, 2, "n/a", None, None, 9, None),
         (2, 2, "n/a", None, None, 9, None)],
        "Row_ID long, Order_ID long, Order_Date string, Ship_Mode string, Customer_ID long, Product_ID long, Profit double")
    customers = spark.createDataFrame([(1, "Ann", "X"), (1, "Bob", "X"), (None, "No", "Y")],
                                      "customer_id long, customer_name string, country string")
    products = spark.createDataFrame([(1, "C", "S")], "Product_ID long, Category string, Sub_Category string")
    for salt in (0, 3):
        with staged(spark) as stage:
            one = silver.enrich_orders(orders, customers, products, salt_buckets=salt)
            steps = silver.enrich_orders(orders, customers, products, salt_buckets=salt, stage=stage)
            assert steps.dtypes == one.dtypes and content(steps) == content(one) and steps.count() == 3
            again = late.joined_again(one, customers.limit(2), products, one.columns, stage=stage)
            assert content(again) == content(late.joined_again(one, customers.limit(2), products, one.columns))


@pytest.mark.parametrize("name, ends", [("json_roundtrip", ".json.gz"), ("json_multiline_roundtrip", ".txt.gz")])
def test_roundtrips_land_compressed_files(spark, folders, name, ends):
    rows = catalog.QUERIES[name](spark, SF_SMALL)
    root = folders["json"][0]
    assert files(f"{root}/orders", ends) and not files(f"{root}/orders", ".json", ".txt")
    assert rows.count() > 0 and all(gone(spark, f) for f in folders.get("stage", []))
    assert "json-files" not in folders


@pytest.mark.parametrize("name, purpose", [("medallion_run", "run"), ("medallion_multiline", "pretty"), ("published_medallion", "published"), ("medallion_observed", "observed"), ("medallion_report", "report")])
def test_runs_land_compressed_orders_and_store_silver_step_by_step(spark, folders, steps, name, purpose):
    catalog.QUERIES[name](spark, SF_SMALL)
    landed = f"{folders[purpose][0]}/raw/orders"
    assert files(landed, ".gz") and not files(landed, ".json", ".txt")
    assert 2 in steps and all(gone(spark, f) for f in folders["stage"])


def test_late_dimensions_stores_each_join_and_the_orders_before_their_years(spark, folders, steps):
    catalog.QUERIES["late_dimensions"](spark, SF_SMALL)
    assert sorted(steps) == [1, 2, 2] and all(gone(spark, f) for f in folders["stage"])


def test_quarantine_lands_compressed_lines_and_drops_its_copy(spark, folders):
    catalog.QUERIES["quarantine_json"](spark, SF_SMALL)
    root = folders["quarantine"][0]
    assert files(f"{root}/orders", ".txt.gz") and not files(f"{root}/orders", ".txt")
    assert len(folders["split"]) == 1 and gone(spark, folders["split"][0])


def test_stream_quarantine_takes_several_batches_and_drops_their_copies(spark, folders):
    catalog.QUERIES["stream_quarantine"](spark, SF_SMALL)
    root = folders["quarantine"][0]
    assert files(f"{root}/orders", ".txt.gz") and not files(f"{root}/orders", ".txt")
    assert len(folders["split"]) >= 2 and all(gone(spark, f) for f in folders["split"])


@pytest.mark.parametrize("distinct", [False, True])
def test_streamed_orders_land_compressed_in_several_batches(spark, folders, distinct):
    root, names = scratch_dir(spark, "t-stream"), catalog._run_names(spark, "disk")
    rows = catalog._stream_orders(spark, SF_SMALL, root, names, distinct)
    assert files(f"{root}/landing", ".json.gz") and not files(f"{root}/landing", ".json")
    batches = spark.table(names.bronze(names.bronze_orders)).select(INGEST_BATCH_COLUMN).distinct().count()
    assert 3 <= batches <= 4 and content(rows) == content(catalog.load_bronze(spark, SF_SMALL).orders.distinct())


def test_stream_medallion_lands_its_orders_once(spark, folders):
    catalog.QUERIES["stream_medallion"](spark, SF_SMALL)
    root = folders["stream"][0]
    assert files(f"{root}/landing", ".json.gz") and not os.path.exists(f"{root}/dimensions/raw/orders".removeprefix("file:"))


def test_a_stream_landing_holds_every_row_in_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(catalog, "LINES_PER_FILE", 50)
    rows = spark.range(3_000).selectExpr("id", "if(id % 3 = 0, null, 'x') AS s").repartition(2)
    glob, per_trigger = catalog._land_for_stream(rows, f"{scratch_dir(spark, 't-land')}/in", "json", triggers=4)
    read = spark.read.schema("id long, s string").json(glob)
    assert content(read) == content(rows)
    sizes = [r["count"] for r in read.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 50 and 3 <= -(-len(sizes) // per_trigger) <= 4


def test_bronze_with_quarantine_keeps_all_records(spark, folders):
    root, names = scratch_dir(spark, "t-raw"), LayerNames(bronze_schema="bronze_disk", silver_schema="silver_disk", gold_schema="gold_disk")
    spark.createDataFrame([('{"a": 1}',), ('{"a": "x"}',), ('{"a": 1}',), ("{",)], "value string").write.text(f"{root}/in")
    pipeline.prepare_schemas(spark, names, root)
    rows = pipeline.process_bronze(spark, SourceSpec(f"{root}/in", "json", "a INT"), names.bronze("t"), quarantine_table=names.bronze("q"))
    assert content(rows) == [(1,)] and spark.table(names.bronze("q")).count() == 2
    assert gone(spark, folders["split"][0])
