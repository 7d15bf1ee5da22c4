"""Token-ID files (6): flat unsigned integers plus 64-bit document offsets.

``write_token_files`` range-partitions the documents by id, encodes each
partition in order and writes, per partition, ``*.ids`` (uint16 where the
vocabulary allows, else uint32, little-endian), ``*.offsets`` (int64, documents
+ 1, counted from the partition's first id) and ``*.docs`` (int64 ids).
A partition's base, the ids of all partitions before it, is a prefix sum over
one manifest row a partition; ``manifest.json`` holds it. File names carry the
task attempt, and the manifest names the attempts that succeeded, so a retried
or speculative task cannot disturb a result. ``read_token_files`` maps the files
into memory again.

Defined results: null text is an empty text (its end id is written); null ids
come first, with an id of 0 and ``null_docs`` in the manifest counting them;
rows of one id are ordered by a hash of their text; equal rows, however many,
spread over the partitions by their place in the input; an empty table gives an
empty folder with a manifest; other columns are left out.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import BYTE_BPE, shared_folder, table, utf8, vocabulary
from strata.llm.encode import ByteLevelEncoder, groups_of

MANIFEST = "part bigint, file string, dtype string, n_docs bigint, null_docs bigint, n_tokens bigint"
READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
_ENCODERS: dict[str, ByteLevelEncoder] = {}


def encoder_of(path: str) -> ByteLevelEncoder:
    """One encoder a Python worker, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteLevelEncoder(path)
    return _ENCODERS[path]


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder, with or without a scheme."""
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> list[dict]:
    """Writes the files below ``folder`` (seen by all executors); returns the manifest."""

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        encoder = encoder_of(tokenizer)
        dtype = "<u2" if max(end_id, len(encoder.piece_bytes) - 1) < 1 << 16 else "<u4"
        store, root = place(folder)
        end = np.array([end_id], "<u4")
        n_docs = null_docs = n_tokens = 0
        with (store.open_output_stream(f"{root}/{name}.ids") as ids_file,
              store.open_output_stream(f"{root}/{name}.offsets") as offsets_file,
              store.open_output_stream(f"{root}/{name}.docs") as docs_file):
            offsets_file.write(np.zeros(1, "<i8").tobytes())
            for batch in batches:
                doc_ids, texts = batch.column(0), utf8(batch.column(1))
                null_docs += doc_ids.null_count
                docs_file.write(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                for part in groups_of(texts):
                    ids, before = encoder.encode(texts[part])
                    ids = np.insert(ids, before[1:], end)
                    ids_file.write(ids.astype(dtype).tobytes())
                    own = before[1:] + np.arange(1, len(before))
                    offsets_file.write((n_tokens + own).astype("<i8").tobytes())
                    n_tokens += len(ids)
                    n_docs += len(own)
        row = [[task.partitionId()], [name], [dtype], [n_docs], [null_docs], [n_tokens]]
        names = [x.split()[0] for x in MANIFEST.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], names=names)

    rows = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .withColumn("copy", F.monotonically_increasing_id())  # equal rows, however many, spread over the partitions
        .repartitionByRange("doc_id", "tie", "copy")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    store, root = place(folder)
    store.create_dir(root, recursive=True)
    parts = sorted(rows.mapInArrow(run, MANIFEST).collect(), key=lambda r: r["part"])  # one row a partition
    base, manifest = 0, []
    for r in parts:
        if r["n_docs"]:
            manifest.append(r.asDict() | {"base": base})
            base += r["n_tokens"]
    with store.open_output_stream(f"{root}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def mapped(folder: str, name: str, dtype: str) -> np.ndarray:
    """A file's numbers: memory-mapped where the folder is mounted, else read."""
    store, root = place(folder)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(f"{root}/{name}", dtype, "r")
    with store.open_input_file(f"{root}/{name}") as f:
        return np.frombuffer(f.read_buffer(), dtype)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, computed from them."""
    store, root = place(folder)
    with store.open_input_file(f"{root}/manifest.json") as f:
        manifest = json.loads(f.read())
    schema = f"{MANIFEST}, base bigint"
    names = [x.split()[0] for x in schema.split(", ")]
    parts = spark.createDataFrame([tuple(r[n] for n in names) for r in manifest], schema)
    out = [x.split()[0] for x in READ.split(", ")]

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = mapped(folder, r["file"] + ".ids", r["dtype"])
                offsets = mapped(folder, r["file"] + ".offsets", "<i8")
                docs = mapped(folder, r["file"] + ".docs", "<i8")
                for a in range(0, r["n_docs"], 20_000):
                    own = np.array(offsets[a : a + 20_001])
                    crc = [zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip(own, own[1:])]
                    doc_ids = np.array(docs[a : a + 20_000])
                    null = np.arange(a, a + len(doc_ids)) < r["null_docs"]
                    arrays = [pa.array(doc_ids, pa.int64(), mask=null), pa.array(r["base"] + own[:-1]),
                              pa.array(np.diff(own)), pa.array(crc, pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, names=out)

    return parts.repartition(max(1, len(manifest)), "part").mapInArrow(run, READ)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary(BYTE_BPE))
    return read_token_files(spark, folder)
