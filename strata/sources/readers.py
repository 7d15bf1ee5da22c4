"""Readers for the raw inputs: CSV files, JSON files, catalogue tables.

Pass ``schema`` (a DDL string or StructType) whenever it is known: schema
inference is an extra full pass over the input before the real read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.settings import SourceSpec

Schema = str | T.StructType | None

_MISSING_PATH_CONDITIONS = {"PATH_NOT_FOUND"}


def _condition(e: AnalysisException) -> str | None:
    get = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    return get() if get else None


def load_files(path: str, load: Callable[[], DataFrame]) -> DataFrame:
    """Run a file load; a missing path becomes FileNotFoundError, other errors propagate."""
    try:
        return load()
    except AnalysisException as e:
        if _condition(e) in _MISSING_PATH_CONDITIONS:
            raise FileNotFoundError(f"source path not found: {path}") from e
        raise


BAD_RECORDS = {"fail": "FAILFAST", "null": "PERMISSIVE"}


def _with_schema(reader, schema: Schema, bad_records: str):
    """Declares the schema.  A record that does not fit it fails the read by
    default; ``bad_records="null"`` lets Spark put nulls in its place."""
    if bad_records not in BAD_RECORDS:
        raise ValueError(f"bad_records must be one of {sorted(BAD_RECORDS)}, got {bad_records!r}")
    return reader.schema(schema).option("mode", BAD_RECORDS[bad_records])


def read_csv(spark: SparkSession, path: str, header: bool = True, infer_schema: bool = True,
             delimiter: str = ",", schema: Schema = None, bad_records: str = "fail") -> DataFrame:
    """CSV file or directory of CSV files.  With ``schema`` no inference pass runs."""
    reader = spark.read.option("header", header).option("delimiter", delimiter)
    if schema is not None:
        reader = _with_schema(reader, schema, bad_records)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return load_files(path, lambda: reader.csv(path))


def read_json(spark: SparkSession, path: str, multi_line: bool = False,
              schema: Schema = None, bad_records: str = "fail") -> DataFrame:
    """JSON file or directory.

    ``multi_line=False`` (JSON Lines) is the default because it splits into
    many tasks per file; ``True`` reads whole files (pretty-printed objects or
    top-level arrays) as one task each, and on a JSON Lines file would return
    only its first record.  Pretty-printed files read as JSON Lines under a
    schema fail (their lines are no records) instead of becoming null rows.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = _with_schema(reader, schema, bad_records)
    return load_files(path, lambda: reader.json(path))


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A catalogue table by (up to three-part) name."""
    return spark.read.table(table)


def read_catalogue_table(spark: SparkSession, catalog: str, schema: str, table: str) -> DataFrame:
    return read_table(spark, f"{catalog}.{schema}.{table}")


def read_source(spark: SparkSession, source: SourceSpec, **options) -> DataFrame:
    """Dispatch on ``source.kind``: csv, json or table; anything else is refused.

    ``source.options`` go to the reader; ``options`` override them.
    """
    kind = source.kind.lower()
    options = {**source.options, **options}
    if kind == "csv":
        return read_csv(spark, source.path, schema=source.schema, **options)
    if kind == "json":
        return read_json(spark, source.path, schema=source.schema, **options)
    if kind == "table":
        return read_table(spark, source.path)
    raise ValueError(f"Invalid source file type: {source.kind!r} (expected csv, json or table)")
