"""Records that do not fit their schema, batch and stream."""

import pytest

from strata.plans.pipeline import prepare_schemas, process_bronze
from strata.session import scratch_dir
from strata.settings import LayerNames, SourceSpec
from strata.sources.quarantine import read_split
from strata.streaming import ingest_files

DDL = "`Order ID` BIGINT, Day DATE, Profit DECIMAL(10,2)"
JSON = ['{"Order ID":1,"Day":"2020-01-02","Profit":1.5}', '{"Order ID":"x","Day":"2020-01-02","Profit":1}', '{"Order ID":3,"Day":"2020',
        '{"Order ID":4}', '', '[1, 2]', '"text"', '{"Order ID":5,"Day":"someday","Profit":"much"}', '{"Order ID":6,"Profit":123456789012.5}',
        '{"Order ID":1,"Day":"2020-01-02","Profit":1.5}', '{}', '{"Order ID":7,"more":8}']
CSV = ["Order ID,Day,Profit", "1,2020-01-02,1.5", "x,2020-01-02,1", "3,2020-01-02", "4,2020-01-02,1,2", "5,someday,much", "6,,", '7,2020-01-02,"1', ""]


def landed(spark, lines, root=None):
    path = f"{root or scratch_dir(spark, 't-raw')}/in"
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)
    return path


def bad(split):
    return sorted((r["raw"], r["reason"]) for r in split.quarantine.collect())


def test_json(spark):
    split = read_split(spark, SourceSpec(landed(spark, JSON), "json", DDL))
    found = dict(bad(split))
    assert found[JSON[1]] == "bad value: Order ID" and found[JSON[2]] == "malformed" and found[JSON[7]] == "bad value: Day, Profit"
    assert found[JSON[8]] == "bad value: Profit" and JSON[6] in found
    assert split.rows.columns == ["Order ID", "Day", "Profit"]
    kept = [r[0] for r in split.rows.collect()]
    records = [x for x in JSON if x]
    print(found, kept)
    assert sorted(k for k in kept if k) == [1, 1, 4, 7] and len(kept) + len(found) == len(records) and set(found) <= set(records)


def test_csv(spark):
    split = read_split(spark, SourceSpec(landed(spark, CSV), "csv", DDL))
    found = dict(bad(split))
    assert found == {CSV[2]: "bad value: Order ID", CSV[3]: "malformed", CSV[4]: "malformed", CSV[5]: "bad value: Day, Profit"}
    assert sorted(r[0] for r in split.rows.collect()) == [1, 6, 7]  # Spark's parser ends an open quote with the line


def test_each_record_is_in_one_of_them_with_its_file(spark):
    root = scratch_dir(spark, "t-raw")
    for k in range(3):
        landed(spark, [f'{{"Order ID":{i}}}' if i % 4 else f'{{"Order ID":"{i}"}}' for i in range(k * 40, k * 40 + 40)], root)
    split = read_split(spark, SourceSpec(f"{root}/in", "json", DDL))
    good, rest = split.rows.collect(), split.quarantine.collect()
    assert sorted([r[0] for r in good] + [int(r["raw"].split('"')[3]) for r in rest]) == list(range(120))
    assert len({r["file"] for r in rest}) == 3 and all(f"{root}/in/part-" in r["file"] for r in rest)


def test_files_are_parsed_once(spark):
    """Both tables are read from the stored records, each from its folder."""
    split = read_split(spark, SourceSpec(landed(spark, JSON), "json", DDL))
    for df, folder in ((split.rows, "_bad=false"), (split.quarantine, "_bad=true")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan json" not in plan and plan.count("FileScan parquet") == 1 and "PartitionFilters: [" in plan
        assert any(folder in f for f in df.inputFiles())


def test_pretty_printed_files(spark):
    path = f"{scratch_dir(spark, 't-raw')}/in"
    for text in ('[\n{"Order ID": 1},\n{"Order ID": 2}\n]', '[\n{"Order ID": 3},\n{"Order ID": '):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(path)
    split = read_split(spark, SourceSpec(path, "json", DDL, {"multi_line": True}))
    assert sorted(r[0] for r in split.rows.collect())[:2] == [1, 2]
    assert len(bad(split)) == 1 and bad(split)[0][0].startswith("[") and bad(split)[0][1] == "malformed"


def test_refused_sources(spark):
    with pytest.raises(ValueError, match="declared schema"):
        read_split(spark, SourceSpec("/nowhere", "csv"))
    with pytest.raises(ValueError, match="Invalid source file type"):
        read_split(spark, SourceSpec("t", "table", DDL))
    with pytest.raises(ValueError, match="reserved"):
        read_split(spark, SourceSpec("/nowhere", "csv", "raw string"))
    with pytest.raises(FileNotFoundError):
        read_split(spark, SourceSpec("/nowhere/at/all", "csv", DDL))


def _names(spark, tag):
    names = LayerNames(bronze_schema=f"bronze_q_{tag}", silver_schema=f"silver_q_{tag}", gold_schema=f"gold_q_{tag}")
    prepare_schemas(spark, names, scratch_dir(spark, "t-q"))
    return names


def test_bronze_table_and_its_quarantine(spark):
    names = _names(spark, "batch")
    out = process_bronze(spark, SourceSpec(landed(spark, CSV), "csv", DDL), names.bronze("orders"), quarantine_table=names.bronze("orders_quarantine"))
    assert out.columns == ["Order_ID", "Day", "Profit"] and out.count() == 3
    assert spark.table(names.bronze("orders_quarantine")).columns == ["raw", "file", "reason"]


def test_streams_of_several_batches(spark):
    names, root = _names(spark, "stream"), scratch_dir(spark, "t-raw")
    for k in range(3):
        landed(spark, [*JSON[:4], f'{{"Order ID":{k + 10}}}'], root)
    source = SourceSpec(f"{root}/in", "json", DDL)
    table, kept = names.bronze("orders"), names.bronze("kept")
    out = ingest_files(spark, source, table, f"{root}/ckpt", max_files_per_trigger=1, quarantine_table=kept)
    assert sorted(r[0] for r in out.collect()) == [1, 4, 10, 11, 12]
    assert spark.table(kept).count() == 6 and spark.table(kept).select("_ingest_batch").distinct().count() == 3
    assert ingest_files(spark, source, table, f"{root}/ckpt", quarantine_table=kept).count() == 5
    assert spark.table(kept).count() == 6


def test_a_batch_without_bad_records(spark):
    names, root = _names(spark, "clean"), scratch_dir(spark, "t-raw")
    landed(spark, JSON[:1], root)
    ingest_files(spark, SourceSpec(f"{root}/in", "json", DDL), names.bronze("o"), f"{root}/ckpt", quarantine_table=names.bronze("k"))
    assert spark.table(names.bronze("k")).count() == 0
