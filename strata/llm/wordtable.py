"""BPE by a distinct-word table (4).

1. Spark splits the texts into words (runs of visible characters with the white
   space before them) in blocks of whole documents. A block's distinct words are
   dealt to buckets by a hash of the word, one row per block and bucket, so a
   word that stands everywhere travels once per block and every bucket gets its
   even share.
2. A bucket's task encodes each distinct word once and sends the ids back.
3. Ids join their block by position: a block keeps, for each word of each
   document, the word's number in the block's table.
4. Decoding joins each id with its piece and reads the pieces' bytes as UTF-8. The
   id-to-piece table is bounded by the vocabulary and an id is its row number, so
   every task holds it and the join is a gather by id, without a shuffle.

The split is made twice, once for the words and once for the blocks: the input
must give the same rows in the same order on every read, as files do. Pass
``stable=False`` for any other frame; it is then written to the shared folder
first. A block whose words do not match raises an error.

Defined results: null text is an empty text (no ids, empty decoded text); null
ids and repeated rows are kept row by row; an empty table gives no rows; other
columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import BYTE_BPE, table, utf8, vocabulary, written
from strata.llm.encode import chunk_keys, gather, groups_of
from strata.llm.tokenfiles import encoder_of

BLOCK_BYTES = 8_000_000
ROWS = "block bigint, bucket int, check bigint, doc_ids array<bigint>, counts array<bigint>, payload binary"
ROW_SCHEMA = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("check", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
                        ("payload", pa.binary())])
OUT = "doc_id bigint, ids binary, decoded binary"


def squeezed(numbers: np.ndarray) -> bytes:
    """uint32 numbers, byte plane after byte plane, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def two_parts(a: bytes, b: bytes) -> bytes:
    return len(a).to_bytes(8, "little") + a + b


def parted(data: bytes) -> tuple[bytes, bytes]:
    n = 8 + int.from_bytes(data[:8], "little")
    return data[8:n], data[n:]


def table_of(encoder, texts: list[bytes], buckets: int):
    """A block's words: (number of each word, words before each text, buffer, starts and ends of the
    distinct words in order of bucket, words of each bucket)."""
    buffer, starts, ends, before = encoder.chunks(texts)
    hashes, identity = chunk_keys(buffer, starts, ends)
    codes, distinct = pd.factorize(hashes)
    first = np.empty(len(distinct), np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    if not all((identity[k][first][codes] == identity[k]).all() for k in range(len(identity))):
        frame = pd.DataFrame(identity.T)  # two words of one hash: number by the words themselves
        codes = frame.groupby(list(frame.columns), sort=False).ngroup().to_numpy()
        _, first = np.unique(codes, return_index=True)
        distinct = hashes[first]
    bucket = (distinct >> np.uint64(20)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    sizes = np.bincount(bucket.astype(np.int64), minlength=buckets)
    return number[codes], before, buffer, starts[first[order]], ends[first[order]], sizes


def _blocks(docs: DataFrame, tokenizer: str, buckets: int, part: str) -> DataFrame:
    """``part`` "words": one row per block and bucket; "docs": one row per block (bucket -1)."""

    def rows(texts, doc_ids, block):
        zstd = zstandard.ZstdCompressor(level=3)
        codes, before, buffer, starts, ends, sizes = table_of(encoder_of(tokenizer), texts, buckets)
        lengths = ends - starts
        check = xxhash.xxh64_intdigest(lengths.tobytes()) >> 1
        if part == "docs":
            yield block, -1, check, doc_ids, np.diff(before).tolist(), squeezed(codes)
            return
        at = np.cumsum(sizes) - sizes
        for k in np.flatnonzero(sizes):
            own = slice(at[k], at[k] + sizes[k])
            words = gather(buffer, starts[own], lengths[own]).tobytes()
            yield block, int(k), check, None, None, two_parts(squeezed(lengths[own]), zstd.compress(words))

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        texts, doc_ids, size = [], [], 0
        for batch in batches:
            new = utf8(batch.column(1))
            ids = batch.column(0).to_pylist()
            for part_of in groups_of(new, BLOCK_BYTES // 4):
                texts += new[part_of]
                doc_ids += ids[part_of]
                size += sum(map(len, new[part_of]))
                if size >= BLOCK_BYTES:
                    yield batch_of(rows(texts, doc_ids, block))
                    block, texts, doc_ids, size = block + 1, [], [], 0
        if texts:
            yield batch_of(rows(texts, doc_ids, block))

    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")]
    return docs.select(*columns).mapInArrow(run, ROWS)


def batch_of(rows) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(ROW_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ROW_SCHEMA)], schema=ROW_SCHEMA)


def _encode_words(words: DataFrame, tokenizer: str) -> DataFrame:
    """The ids of each row's words: payload holds ids of each word and all ids."""

    def run(batches):
        encoder = encoder_of(tokenizer)
        zstd = zstandard.ZstdDecompressor()
        for batch in batches:
            for r in range(batch.num_rows):
                block, bucket, check = (batch.column(k)[r].as_py() for k in range(3))
                sizes, data = parted(batch.column(5)[r].as_py())
                lengths = unsqueezed(sizes).astype(np.int64)
                buffer = np.frombuffer(zstd.decompress(data) + b"\0" * 32, np.uint8)
                ends = np.cumsum(lengths)
                own = encoder.lookup(buffer, ends - lengths, ends)
                if own is None:  # two words of one hash
                    ids, counts = encoder._encode_new(buffer, ends - lengths, ends)
                else:
                    counts = encoder.count[own]
                    ids = gather(encoder.pool, encoder.at[own], counts)
                payload = two_parts(squeezed(counts), squeezed(ids))
                yield batch_of([(block, bucket, check, None, None, payload)])

    return words.mapInArrow(run, ROWS)


def pieces_of(tokenizer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all pieces, start and size of each id's piece): the id-to-piece table of byte-level BPE."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    vocab = tokenizer.get_vocab(with_added_tokens=True)
    pieces = [b""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        pieces[i] = bytes(byte_of[c] for c in piece)
    sizes = np.array([len(p) for p in pieces], np.int64)
    return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(sizes) - sizes, sizes


def decode(ids: np.ndarray, pieces) -> bytes:
    """UTF-8 of the ids' text, as the library decodes it (bad UTF-8 becomes U+FFFD)."""
    pool, at, sizes = pieces
    data = gather(pool, at[ids], sizes[ids]).tobytes()
    return data.decode("utf-8", "replace").encode()


def encode_decode(docs: DataFrame, tokenizer: str, buckets: int | None = None, stable: bool = True,
                  digest: bool = False) -> DataFrame:
    """(doc_id, ids as little-endian uint32, decoded text in UTF-8) of every row.

    With ``digest`` the last two are (doc_id, n_tokens, ids_sha256, decoded_sha256).
    """
    spark = docs.sparkSession
    if not stable:
        docs = written(docs.select("doc_id", "text"), "word-table")
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = _blocks(docs, tokenizer, buckets, "words").repartition("bucket")
    # the blocks first: a union numbers its tasks side by side, so they are numbered as in the words' own stage
    both = _blocks(docs, tokenizer, buckets, "docs").unionByName(_encode_words(words, tokenizer))

    def results(doc, parts):
        block, doc_ids, counts, codes, check = doc
        if any(p[2] != check for p in parts):
            raise RuntimeError(f"block {block} differs between two reads of the input: pass stable=False")
        decoded = [tuple(map(unsqueezed, parted(p[1]))) for p in sorted(parts, key=lambda p: p[0])]
        sizes = np.concatenate([np.empty(0, np.int64), *(d[0] for d in decoded)]).astype(np.int64)
        pool = np.concatenate([np.empty(0, "<u4"), *(d[1] for d in decoded)])
        at = np.cumsum(sizes) - sizes
        pieces = _pieces(tokenizer)
        ends = np.cumsum(counts)
        for i, (a, b) in enumerate(zip(ends - counts, ends)):
            own = codes[a:b]
            ids = gather(pool, at[own], sizes[own])
            yield doc_ids[i], ids.tobytes(), decode(ids, pieces)

    def run(batches):
        doc, parts = None, []
        for batch in batches:
            for r in range(batch.num_rows):
                block, bucket, check, doc_ids, counts, payload = (c[r].as_py() for c in batch.columns)
                if bucket < 0:
                    if doc is not None:
                        yield from shown(results(doc, parts))
                    codes = unsqueezed(payload).astype(np.int64)
                    doc, parts = (block, doc_ids, np.array(counts, np.int64), codes, check), []
                elif doc is None or doc[0] != block:
                    raise RuntimeError(f"block {block} is missing: pass stable=False")
                else:
                    parts.append((bucket, payload, check))
        if doc is not None:
            yield from shown(results(doc, parts))

    def shown(rows):
        """Batches of a few MB."""
        out, size = [], 0
        for doc_id, ids, text in rows:
            size += len(ids) + len(text)
            if digest:
                out.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()))
            else:
                out.append((doc_id, ids, text))
            if size >= 8_000_000:
                yield arrow(out)
                out, size = [], 0
        if out:
            yield arrow(out)

    def arrow(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[x.split()[0] for x in schema.split(", ")])

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digest else OUT
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()] if digest else [pa.int64(), pa.binary(), pa.binary()]
    return both.repartition("block").sortWithinPartitions("block", "bucket").mapInArrow(run, schema)


_PIECES: dict[str, tuple] = {}


def _pieces(path: str):
    if path not in _PIECES:
        _PIECES[path] = pieces_of(encoder_of(path).tokenizer)
    return _PIECES[path]


def op4_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE), digest=True)
