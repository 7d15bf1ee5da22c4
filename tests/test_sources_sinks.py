import json
import tempfile

import pytest

from strata.session import scratch_dir
from strata.settings import LayerNames, SourceSpec
from strata.sources.readers import read_csv, read_json, read_source, read_table
from strata.sources.sinks import ensure_schema, require_rows, write_table


def test_csv_infers_schema_and_reads_directory(spark):
    root = tempfile.mkdtemp(prefix="t-csv-")
    with open(f"{root}/a.csv", "w") as f:
        f.write("Product ID,Sub-Category,price\n1,x,1.5\n2,y,2.25\n")
    df = read_csv(spark, root)
    assert df.columns == ["Product ID", "Sub-Category", "price"]
    assert dict(df.dtypes)["price"] == "double"
    assert df.count() == 2


def test_csv_with_schema_and_delimiter(spark):
    root = tempfile.mkdtemp(prefix="t-csv-")
    with open(f"{root}/a.csv", "w") as f:
        f.write("a;b\n1;x\n")
    df = read_csv(spark, root, delimiter=";", schema="a bigint, b string")
    assert df.dtypes == [("a", "bigint"), ("b", "string")]


def test_json_lines_vs_multiline(spark):
    root = tempfile.mkdtemp(prefix="t-json-")
    with open(f"{root}/lines.json", "w") as f:
        f.write('{"a": 1}\n{"a": 2}\n')
    assert read_json(spark, f"{root}/lines.json").count() == 2
    # multiLine on a JSON Lines file only sees the first record
    assert read_json(spark, f"{root}/lines.json", multi_line=True).count() == 1
    with open(f"{root}/array.json", "w") as f:
        f.write('[\n  {"a": 1},\n  {"a": 2}\n]\n')
    assert read_json(spark, f"{root}/array.json", multi_line=True).count() == 2


def test_declared_schema_refuses_records_that_do_not_fit(spark):
    root = tempfile.mkdtemp(prefix="t-json-")
    with open(f"{root}/pretty.json", "w") as f:
        json.dump([{"a": 1}, {"a": 2}], f, indent=2)
    path, ddl = f"{root}/pretty.json", "a bigint"
    assert read_json(spark, path, multi_line=True, schema=ddl).count() == 2
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        read_json(spark, path, schema=ddl).collect()
    assert read_json(spark, path, schema=ddl, bad_records="null").where("a is not null").count() == 0
    with pytest.raises(ValueError, match="bad_records"):
        read_json(spark, path, schema=ddl, bad_records="skip")


def test_reader_options_travel_with_the_source(spark):
    root = tempfile.mkdtemp(prefix="t-json-")
    with open(f"{root}/pretty.json", "w") as f:
        json.dump([{"a": 1}, {"a": 2}], f, indent=2)
    source = SourceSpec(f"{root}/pretty.json", "json", "a bigint", {"multi_line": True})
    assert read_source(spark, source).count() == 2
    with open(f"{root}/a.csv", "w") as f:
        f.write("1;x\n2;y\n")
    source = SourceSpec(f"{root}/a.csv", "csv", "a bigint, b string", {"delimiter": ";", "header": False})
    assert read_source(spark, source).count() == 2
    assert read_source(spark, source, header=True).count() == 1  # the caller's word counts


def test_a_second_read_sees_appended_files(spark):
    from strata.sources.adapters import read_tpch

    root = tempfile.mkdtemp(prefix="t-tpch-")
    spark.range(5).write.parquet(f"{root}/part.parquet")
    assert read_tpch(spark, root, "part").count() == 5
    spark.range(7).write.mode("append").parquet(f"{root}/part.parquet")
    assert read_tpch(spark, root, "part").count() == 12


def test_missing_path_is_file_not_found(spark):
    with pytest.raises(FileNotFoundError):
        read_csv(spark, "/nonexistent/strata/x.csv")
    with pytest.raises(FileNotFoundError):
        read_json(spark, "/nonexistent/strata/x.json")


def test_source_dispatch(spark):
    with pytest.raises(ValueError, match="Invalid source file type"):
        read_source(spark, SourceSpec("/x/Customer.xlsx", "xlsx"))


def test_write_table_dedups_and_overwrites_schema(spark):
    root = scratch_dir(spark, "t-tables")
    names = LayerNames(bronze_schema="t_sink")
    ensure_schema(spark, names.catalog, names.bronze_schema, f"{root}/t_sink.db")
    t = names.bronze("t")
    write_table(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string"), t)
    assert read_table(spark, t).count() == 2
    write_table(spark.createDataFrame([(1.5,)], "other double"), t)
    assert read_table(spark, t).columns == ["other"]
    write_table(spark.createDataFrame([(1, "a"), (1, "a")], "k int, v string"), t, dedup=False)
    assert read_table(spark, t).count() == 2


def test_require_rows(spark):
    require_rows({"a": spark.range(1)})
    with pytest.raises(ValueError, match="No data in bronze tables: b, c"):
        require_rows({"a": spark.range(1), "b": spark.range(0), "c": spark.range(0)}, "bronze tables")
