"""Records that do not fit their declared schema, kept aside instead of failing the read or turning null.

One pass parses the files with a corrupt-record column and stores every record,
good ones and bad ones in a folder each; the two tables are read from there, so
the files are read and parsed once.  Every record is in exactly one of them:
rows + quarantined = records.

A quarantined record keeps its raw text, its file and a reason:

* ``malformed``: no JSON object, or not as many CSV fields as columns;
* ``bad value: A, B``: the named columns hold values of another type;
* ``unreadable``: the parser refused it for another reason.

The reason is found by parsing the raw text again with all columns as strings,
which only quarantined records pay for.  Blank lines are no records, as Spark's
readers have it.  Of a pretty-printed file (``multi_line``) the raw text is what
the parser gives: the whole file, however many of its objects are bad; one bad
object then quarantines its file's objects that do not fit, each with that text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import release_folder, scratch_dir, shuffles_dropped
from strata.settings import SourceSpec
from strata.sources.readers import load_files

RAW, FILE, REASON = "raw", "file", "reason"
_CORRUPT, _BAD = "_corrupt_record", "_bad"


@dataclass(frozen=True)
class SplitRead:
    """``rows`` as the schema declares them, ``quarantine`` as (raw, file, reason); ``folder`` holds the records of both."""

    rows: DataFrame
    quarantine: DataFrame
    folder: str

    def release(self) -> None:
        """Drops the stored records, once rows and quarantine have been written elsewhere."""
        release_folder(self.rows.sparkSession, self.folder)


def declared(schema: str | T.StructType) -> T.StructType:
    found = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    clash = {_CORRUPT, _BAD, FILE, RAW, REASON} & {n.lower() for n in found.names}
    if clash:
        raise ValueError(f"the schema uses reserved names: {sorted(clash)}")
    return found


def parser_options(source: SourceSpec) -> dict[str, object]:
    """Options of Spark's reader, batch or stream, that put a bad record's text into its own column."""
    options: dict[str, object] = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    if source.kind.lower() == "csv":
        return {**options, "header": source.options.get("header", True), "delimiter": source.options.get("delimiter", ",")}
    return {**options, "multiLine": source.options.get("multi_line", False)}


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])


def with_file(records: DataFrame) -> DataFrame:
    """Parsed records with their file and whether they are bad; to be stored before anything else."""
    return records.withColumn(FILE, F.col("_metadata.file_path")).withColumn(_BAD, F.col(_CORRUPT).isNotNull())


def _reason(source: SourceSpec, schema: T.StructType) -> Column:
    strings = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(_CORRUPT, T.StringType())])
    options = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in parser_options(source).items()
               if k not in ("header", "multiLine")}
    parse = F.from_csv if source.kind.lower() == "csv" else F.from_json
    how = strings.simpleString() if parse is F.from_json else ", ".join(f"`{f.name}` STRING" for f in strings)
    again = parse(F.col(_CORRUPT), strings if parse is F.from_json else how, options)
    named = F.concat_ws(", ", *[F.when(again[f.name].isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f.name)) for f in schema])
    return (F.when(again.isNull() | again[_CORRUPT].isNotNull(), F.lit("malformed"))
            .when(named != "", F.concat(F.lit("bad value: "), named)).otherwise(F.lit("unreadable")))


def stored_split(marked: DataFrame, source: SourceSpec, schema: T.StructType) -> SplitRead:
    """Writes ``with_file`` records, good and bad ones in a folder each, and reads them back: a filter on either reads its folder only."""
    path = scratch_dir(marked.sparkSession, "split")
    with shuffles_dropped(marked.sparkSession):
        marked.write.partitionBy(_BAD).option("compression", "zstd").parquet(path)
    stored = marked.sparkSession.read.schema(marked.schema).parquet(path)
    rows = stored.where(~F.col(_BAD)).select(*[F.col(f"`{n}`") for n in schema.names])
    bad = stored.where(F.col(_BAD)).select(F.col(_CORRUPT).alias(RAW), FILE, _reason(source, schema).alias(REASON))
    return SplitRead(rows, bad, path)


def read_split(spark: SparkSession, source: SourceSpec) -> SplitRead:
    """A CSV or JSON source with a declared schema, as rows and quarantine (see the module)."""
    kind = source.kind.lower()
    if kind not in ("csv", "json"):
        raise ValueError(f"Invalid source file type: {source.kind!r} (expected csv or json)")
    if source.schema is None:
        raise ValueError("a record can only fail to fit a declared schema: give source.schema")
    schema = declared(source.schema)
    reader = spark.read.schema(with_corrupt_column(schema)).options(**parser_options(source))
    records = load_files(source.path, lambda: getattr(reader, kind)(source.path))
    return stored_split(with_file(records), source, schema)
