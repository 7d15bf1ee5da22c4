"""Helpers of the operators: the shared folder, written tables, UTF-8 columns."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from strata.session import scratch_dir

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder's path under ``spark.checkpoint.dir``; ``session.release_scratch`` drops it."""
    return scratch_dir(spark, f"llm-{purpose}")


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once a session."""
    context = spark.sparkContext
    if getattr(context, "_strata_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="strata-ship-"), "strata_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(archive)
    context._strata_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the executors can import this package from here on."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read again: lineage ends here, and every reader sees the same rows."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column) -> list[bytes]:
    """A string column's values as UTF-8; null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
