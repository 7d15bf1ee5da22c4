"""Bronze ingest as a file stream (``trigger(availableNow=True)``).

Semantics versus the batch ``process_bronze``:
* every micro-batch is cleaned and de-duplicated, then written to its own
  partition ``_ingest_batch=<id>``, which it always overwrites, so a batch
  re-run after a failure replaces its own output instead of appending it twice
  (the sink is idempotent; the checkpoint makes the source exactly-once);
* the table is created, empty, before the first batch, and a batch is stored by
  column name: one whose columns or types differ from the table's is refused;
* copies that arrive in *different* batches lie in different partitions.
  ``bronze_rows`` is the table's content: the distinct rows without the batch
  column, the same whatever files a batch happened to hold.  Silver and the
  checks read every bronze table through it (``plans.pipeline``);
* with ``distinct=True`` copies from earlier batches are left out on arrival
  instead, and readers need no de-duplication.  A second table, ``<table>_seen``,
  holds the 128-bit digests of all stored rows, bucketed by digest: a batch is
  shuffled once by digest, which also meets its own copies, and joins its
  buckets, so the history is neither shuffled nor read at full width (16 bytes a
  row).  Digests of the batch itself are left out of the join, so a batch that
  runs again after a failure anywhere stores the same rows.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.naming import clean_column_names
from strata.settings import SourceSpec
from strata.sources.quarantine import (
    declared,
    parser_options,
    stored_split,
    with_corrupt_column,
    with_file,
)
from strata.sources.readers import BAD_RECORDS

INGEST_BATCH_COLUMN = "_ingest_batch"
#: Of a stored row in a table of distinct rows: its digest.
DIGEST = ("_digest_a", "_digest_b")
SEEN = "_seen"


def with_digest(df: DataFrame) -> DataFrame:
    """Two 64-bit hashes of the whole row; nulls count by their place, and equal rows have equal digests."""
    known = [F.col(f"`{c}`").isNull() for c in df.columns]
    whole = [F.col(f"`{c}`") for c in df.columns]
    return df.withColumns({d: F.xxhash64(F.lit(i), *known, *whole) for i, d in enumerate(DIGEST)})


def bronze_rows(table: DataFrame, distinct: bool = True) -> DataFrame:
    """A bronze table's rows: of a streamed one, without the batch column, and distinct unless told otherwise
    (a table whose rows carry their digests is distinct as it is stored)."""
    if INGEST_BATCH_COLUMN not in table.columns:
        return table
    rows = table.drop(INGEST_BATCH_COLUMN, *DIGEST)
    return rows.dropDuplicates() if distinct and DIGEST[0] not in table.columns else rows


def create_bronze_table(spark: SparkSession, target_table: str, like: DataFrame, fmt: str) -> None:
    """The empty partitioned table for batches shaped ``like`` this one, unless it exists.

    Files that a lost attempt left in the table's folder do not stand in the
    way: the table is then laid over that folder, and as its partitions are
    only those that batches write (and overwrite), the files are not read.
    """
    if spark.catalog.tableExists(target_table):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
    create = (f"CREATE TABLE IF NOT EXISTS {target_table} ({columns}, {INGEST_BATCH_COLUMN} BIGINT) "
              f"USING {fmt} PARTITIONED BY ({INGEST_BATCH_COLUMN})")
    try:
        spark.sql(create)
    except PySparkException as e:
        if "LOCATION_ALREADY_EXISTS" not in str(e):
            raise
        schema, name = target_table.rsplit(".", 1)
        described = spark.sql(f"DESCRIBE NAMESPACE {schema}").where("info_name = 'Location'").first()
        spark.sql(f"{create} LOCATION '{described['info_value']}/{name}'")


def _seen_table(spark: SparkSession, target_table: str, fmt: str) -> tuple[str, int]:
    """(name, buckets) of the digests' table; a new one gets as many buckets as the session has shuffle partitions."""
    seen = target_table + SEEN
    if not spark.catalog.tableExists(seen):
        columns = ", ".join(f"{d} BIGINT" for d in DIGEST)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {seen} ({columns}, {INGEST_BATCH_COLUMN} BIGINT) USING {fmt} "
                  f"PARTITIONED BY ({INGEST_BATCH_COLUMN}) CLUSTERED BY ({', '.join(DIGEST)}) "
                  f"INTO {spark.conf.get('spark.sql.shuffle.partitions')} BUCKETS")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {seen}").where("col_name = 'Num Buckets'").first()
    return seen, int(described["data_type"])


def _put_distinct(rows: DataFrame, batch_id: int, target_table: str, fmt: str) -> None:
    """Stores the batch's rows that no earlier batch has stored, then their digests."""
    spark = rows.sparkSession
    seen, buckets = _seen_table(spark, target_table, fmt)
    earlier = spark.read.table(seen).where(F.col(INGEST_BATCH_COLUMN) != batch_id).select(*DIGEST)
    batch = with_digest(rows).repartition(buckets, *DIGEST).dropDuplicates(list(DIGEST))
    _put(batch.join(earlier.hint("shuffle_hash"), list(DIGEST), "left_anti").select(*rows.columns, *DIGEST),
         batch_id, target_table, fmt)
    stored = spark.read.table(target_table).where(F.col(INGEST_BATCH_COLUMN) == batch_id).select(*DIGEST)
    spark.sql(f"INSERT OVERWRITE TABLE {seen} PARTITION ({INGEST_BATCH_COLUMN} = {int(batch_id)}) "
              f"SELECT {', '.join(DIGEST)} FROM {{stored}}", stored=stored)


def _put(out: DataFrame, batch_id: int, target_table: str, fmt: str) -> None:
    """Stores a batch's rows as exactly its partition of the table."""
    spark = out.sparkSession
    create_bronze_table(spark, target_table, out, fmt)
    stored = {f.name: f.dataType for f in spark.read.table(target_table).schema if f.name != INGEST_BATCH_COLUMN}
    given = {f.name: f.dataType for f in out.schema}
    if stored != given:
        raise ValueError(f"batch {batch_id} does not fit {target_table}: {given} against {stored}")
    # A static partition spec replaces exactly this batch's partition,
    # whatever spark.sql.sources.partitionOverwriteMode says.
    columns = ", ".join(f"`{c}`" for c in stored)
    spark.sql(f"INSERT OVERWRITE TABLE {target_table} PARTITION ({INGEST_BATCH_COLUMN} = {int(batch_id)}) "
              f"({columns}) SELECT {columns} FROM {{batch}}", batch=out)


def _put_rows(rows: DataFrame, batch_id: int, target_table: str, fmt: str, distinct: bool) -> None:
    rows = clean_column_names(rows)
    if distinct:
        _put_distinct(rows, batch_id, target_table, fmt)
    else:
        _put(rows.dropDuplicates(), batch_id, target_table, fmt)


def _batch_writer(target_table: str, fmt: str, distinct: bool = False):
    def write(batch: DataFrame, batch_id: int) -> None:
        _put_rows(batch, batch_id, target_table, fmt, distinct)
    return write


def _splitting_writer(target_table: str, quarantine_table: str, source: SourceSpec, fmt: str, distinct: bool):
    """Rows and quarantined records of a batch, each into its own partition; the batch is parsed once."""
    schema = declared(source.schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        split = stored_split(batch, source, schema)
        _put(split.quarantine, batch_id, quarantine_table, fmt)
        _put_rows(split.rows, batch_id, target_table, fmt, distinct)
        split.release()
    return write


def ingest_files(spark: SparkSession, source: SourceSpec, target_table: str, checkpoint: str,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None,
                 quarantine_table: str | None = None, distinct: bool = False) -> DataFrame:
    """Ingest every not-yet-seen file under ``source.path`` into ``target_table``.

    ``source.schema`` is required (a stream cannot infer one);
    ``source.options`` may hold header, delimiter, multi_line and bad_records.
    With ``quarantine_table`` records that do not fit go there (raw text, file,
    reason; ``sources.quarantine``) instead of failing the batch.
    ``distinct=True`` stores no row twice, whatever batches its copies arrive in.
    ``checkpoint`` must be on the shared file system (e.g. under
    ``spark.checkpoint.dir``).  Blocks until the available files are processed;
    returns the table's rows (``bronze_rows``).
    """
    if source.schema is None:
        raise ValueError("a streaming ingest needs source.schema")
    kind, options = source.kind.lower(), source.options
    if kind not in ("csv", "json"):
        raise ValueError(f"Invalid source file type: {source.kind!r} (expected csv or json)")
    read_options = parser_options(source)
    reader = spark.readStream
    if quarantine_table:
        reader = reader.schema(with_corrupt_column(declared(source.schema))).options(**read_options)
    else:
        del read_options["columnNameOfCorruptRecord"]
        read_options["mode"] = BAD_RECORDS[options.get("bad_records", "fail")]
        reader = reader.schema(source.schema).options(**read_options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(source.path) if kind == "csv" else reader.json(source.path)
    if quarantine_table:
        stream, write = with_file(stream), _splitting_writer(target_table, quarantine_table, source, fmt, distinct)
    else:
        write = _batch_writer(target_table, fmt, distinct)
    query = (stream.writeStream.foreachBatch(write)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return bronze_rows(spark.read.table(target_table))
