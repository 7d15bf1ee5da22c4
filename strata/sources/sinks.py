"""Table sinks: de-duplicating overwrite and non-empty guards."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from strata.session import release_folder, scratch_dir, shuffles_dropped


def ensure_schema(spark: SparkSession, catalog: str, schema: str, location: str | None = None) -> None:
    """Create ``catalog.schema`` if missing (optionally at a given folder)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {catalog}.{schema}{loc}")


Watch = Callable[[DataFrame], DataFrame]


def laid_out(df: DataFrame, dedup: bool = True, partition_by: Sequence[str] | None = None,
             watch: Watch | None = None) -> DataFrameWriter:
    """A writer of the frame, full-row de-duplicated unless told otherwise.

    The de-dup is a hash aggregation with map-side partial aggregation, so a
    row copied into a third of the input reaches the shuffle once per map
    task.  A partitioned write is rebalanced on the partition columns first
    (``REBALANCE`` hint): without it every task writes a file into every
    partition folder it holds (tasks x folders small files); with it each
    folder's rows meet in a few tasks, and AQE splits a folder holding a
    large share of the rows into advisory-size pieces instead of one task.
    ``watch`` is applied to the rows as they are written
    (``operators.observed.WriteChecks.watch``).
    """
    out = df.dropDuplicates() if dedup else df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    if watch:
        out = watch(out)
    return out.write.partitionBy(*partition_by) if partition_by else out.write


def write_table(df: DataFrame, table: str, fmt: str = "parquet", dedup: bool = True,
                partition_by: Sequence[str] | None = None, mode: str = "overwrite",
                watch: Watch | None = None) -> None:
    """(Over)write ``table`` with the frame's rows (``laid_out``) and schema.

    Overwriting a table that the same plan reads from is refused by Spark
    (UNSUPPORTED_OVERWRITE.TABLE); a ``plans.publish`` run can do that.
    """
    writer = laid_out(df, dedup, partition_by, watch).format(fmt).mode(mode)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    with shuffles_dropped(df.sparkSession):
        writer.saveAsTable(table)


def require_rows(frames: Mapping[str, DataFrame], what: str = "input") -> None:
    """Raise ValueError naming every empty frame; each check reads at most one row.

    All frames are checked before anything is written, so a failure leaves
    no layer half-replaced.
    """
    empty = [name for name, df in frames.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"No data in {what}: {', '.join(empty)}")


def materialize(df: DataFrame, purpose: str = "frame") -> DataFrame:
    """Write ``df`` once as parquet under the shared scratch folder and read it back.

    For a frame that several later computations consume (the quality checks
    all read silver orders): they scan the stored copy instead of each
    recomputing its joins.  This also cuts the lineage, so a lost executor
    re-reads the copy rather than recomputing from the raw inputs.  Unlike
    ``DataFrame.checkpoint`` the plan runs once (no count-then-write).
    """
    return _stored(df, scratch_dir(df.sparkSession, purpose))


def _stored(df: DataFrame, path: str) -> DataFrame:
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


Stage = Callable[[DataFrame], DataFrame]


@contextmanager
def staged(spark: SparkSession) -> Iterator[Stage]:
    """``stage(df)`` stores a step of a longer plan and gives the copy back, for the next step to read.

    The shuffle files of one execution lie on disk together until it ends, so
    a plan that moves the whole fact several times holds as many copies of it.
    Stored step by step it holds one shuffle and the copy it reads: each copy
    is dropped when the next one is stored, the last one at the end of the
    block.  So a step reads the copy before it and none older, and frames that
    read the last copy must be written inside the block.
    """
    last: list[str] = []

    def stage(df: DataFrame) -> DataFrame:
        path = scratch_dir(spark, "stage")
        copy = _stored(df, path)
        if last:
            release_folder(spark, last.pop())
        last.append(path)
        return copy

    try:
        yield stage
    finally:
        if last:
            release_folder(spark, last.pop())
