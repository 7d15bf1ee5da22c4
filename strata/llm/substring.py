"""Substring dedup (8): De Bruijn compaction of long repeated word spans.

The edges are the windows of ``window`` consecutive words. A path is a run of
consecutive windows with one and the same minimiser (the least of the hashed
shorter k-mers in a window, leftmost among equals): equal windows always have
equal minimisers, so equal edges lie in paths of one minimiser, and a path's
windows all differ.

1. The documents are written once, in compressed blocks. Each block sends the
   minimisers of its paths to buckets, with a hash of all words of the path or, if
   the block has several paths of one minimiser, a sign that there are many: one
   row per block and bucket, so a passage that stands everywhere travels once per
   block, whatever stands around it.
2. A bucket's task compacts: a minimiser met once has no repeated edge; if all its
   paths are one, that path repeats with all its edges; where one minimiser has
   different paths (a branch), they must be opened. The answers join the blocks.
3. Opened paths send their single windows the same way, to buckets by the window; a
   window met twice repeats.
4. Both answers join the blocks again by source coordinates: each repeated window
   covers its words there, and covered words go.

Windows count by (minimiser, hash of the window), 128 bits over words hashed
from all their bytes. Windows are judged on the input. Memory is one block
and one bucket; buckets grow in number with the shuffle partitions.

Defined results: null or empty text has no words; fewer words than the window:
nothing is removed; repeated rows repeat all their windows, so texts of at least
``window`` words go whole (every copy); null ids stay; an empty table gives no
rows; columns other than ``keep`` are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import table, utf8, written
from strata.llm.encode import chunk_keys, cut_chunks, groups_of

BLOCK_BYTES = 4_000_000
K = 10  # words of a minimiser
ROWS = ("block bigint, step int, bucket int, doc_ids array<bigint>, sizes array<bigint>, "
        "meta array<string>, payload binary")
ROW_SCHEMA = pa.schema([("block", pa.int64()), ("step", pa.int32()), ("bucket", pa.int32()),
                        ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                        ("meta", pa.list_(pa.string())), ("payload", pa.binary())])
_R = np.uint64(0xD6E8FEB86659FD93)  # odd, so it has an inverse modulo 2 ** 64
_RINV = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
WHOLE, OPEN = 1, 2  # answers about a path
MANY = 3  # count of a minimiser with several contents in one block


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(r: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, r, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """Words of a block's texts, with hashes of any run of them."""

    def __init__(self, texts: list[bytes]):
        self.buffer, self.starts, self.ends, self.before = cut_chunks(texts, [False] * len(texts), False, stops=False)
        hashes, _ = chunk_keys(self.buffer, self.starts, self.ends)
        self.n = len(hashes)
        self.back = powers(_RINV, self.n + 1)
        sums = np.cumsum(mixed(hashes) * powers(_R, self.n), dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), sums])

    def run_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words start..end-1, wherever they stand."""
        h = (self.sums[end] - self.sums[start]) * self.back[start]
        return mixed(h + (end - start).astype(np.uint64))

    def paths(self, window: int):
        """(first window, windows, minimiser) of each path."""
        none = np.empty(0, np.int64)
        if self.n < window:
            return none, none, none.astype(np.uint64)
        at = np.arange(self.n - K + 1)
        kmers = self.run_hash(at, at + K)
        low = np.uint64((1 << 28) - 1)
        key = (kmers & ~low) | at.astype(np.uint64)
        span, size = window - K + 1, 1
        while size * 2 <= span:
            key = np.minimum(key[: len(key) - size], key[size:])
            size *= 2
        if size < span:
            key = np.minimum(key[: len(key) - (span - size)], key[span - size :])
        owner = (key & low).astype(np.int64)  # leftmost least k-mer of each window
        valid = np.zeros(len(owner), bool)
        for a, b in zip(self.before[:-1].tolist(), self.before[1:].tolist()):
            if b - a >= window:
                valid[a : b - window + 1] = True
        at = np.flatnonzero(valid)
        if not len(at):
            return none, none, none.astype(np.uint64)
        new = np.concatenate([[True], (np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])])
        first = np.flatnonzero(new)
        return at[first], np.diff(np.append(first, len(at))), kmers[owner[at[first]]]


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((mixed(key) >> np.uint64(16)) % np.uint64(buckets)).astype(np.int64)


class Dealt:
    """The distinct (minimiser, content) of some rows, in order of bucket.

    m, c: theirs; count: how often each stands here (2: more than once); at: the
    row where each first stands; number: each row's place among them; cuts:
    places between the buckets.
    """

    def __init__(self, minimiser: np.ndarray, content: np.ndarray, bucket: np.ndarray, buckets: int):
        order = np.lexsort((content, minimiser, bucket))
        m, c = minimiser[order], content[order]
        new = np.ones(len(m), bool)
        new[1:] = (m[1:] != m[:-1]) | (c[1:] != c[:-1])
        first = np.flatnonzero(new)
        self.m, self.c, self.at = m[first], c[first], order[first]
        self.number = np.empty(len(m), np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.count = np.minimum(np.diff(np.append(first, len(m))), 2).astype(np.uint8)
        self.cuts = np.searchsorted(bucket[self.at], np.arange(buckets + 1))

    def by_minimiser(self):
        """(minimiser, content, count; kind of each of these): one row a minimiser, MANY if it has several contents."""
        new = np.ones(len(self.m), bool)
        new[1:] = self.m[1:] != self.m[:-1]
        first = np.flatnonzero(new)
        several = np.diff(np.append(first, len(new))) > 1
        return self.m[first], self.c[first], np.where(several, MANY, self.count[first]).astype(np.uint8), np.cumsum(new) - 1


def row_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(ROW_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ROW_SCHEMA)], schema=ROW_SCHEMA)


def questions(block: int, step: int, m, c, count, cuts) -> list[tuple]:
    """One row per bucket that has something: minimisers, contents, counts."""
    return [(block, step, int(k), None, None, None, m[a:b].tobytes() + c[a:b].tobytes() + count[a:b].tobytes())
            for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if b > a]


def answers(step: int, rows: list[tuple[int, int, bytes]]) -> list[tuple]:
    """Answers to all questions of one bucket: a byte for each, in order."""
    sizes = np.array([len(p) // 17 for _, _, p in rows])
    parts = [(np.frombuffer(p, "<u8", 2 * n), np.frombuffer(p, np.uint8, n, 16 * n)) for (_, _, p), n in zip(rows, sizes)]
    m = np.concatenate([x[:n] for (x, _), n in zip(parts, sizes)])
    c = np.concatenate([x[n:] for (x, _), n in zip(parts, sizes)])
    count = np.concatenate([y for _, y in parts]).astype(np.int64)
    order = np.lexsort((c, m))
    m, c, count = m[order], c[order], count[order]
    new_m, new_c = np.ones(len(m), bool), np.ones(len(m), bool)
    new_m[1:] = m[1:] != m[:-1]
    new_c[1:] = new_m[1:] | (c[1:] != c[:-1])
    kind, group = np.cumsum(new_c) - 1, np.cumsum(new_m) - 1
    reply = np.where(np.bincount(kind, count)[kind] >= 2, WHOLE, 0)
    if step == 1:  # a minimiser with several contents, here or in one block
        branch = (np.bincount(group, new_c) > 1) | (np.bincount(group, count == MANY) > 0)
        reply = np.where(branch[group], OPEN, reply)
    out = np.empty(len(reply), np.uint8)
    out[order] = reply
    ends = np.cumsum(sizes)
    return [(block, step, bucket, None, None, None, out[e - n : e].tobytes())
            for (block, bucket, _), n, e in zip(rows, sizes.tolist(), ends.tolist())]


class Block:
    """A block's documents with the answers that have come for them."""

    def __init__(self, row: tuple, window: int, buckets: int):
        self.block, _, _, self.doc_ids, self.sizes, self.meta, data = row
        data = zstandard.ZstdDecompressor().decompress(data)
        ends = np.cumsum(self.sizes).tolist()
        self.texts = [data[e - n : e] for e, n in zip(ends, self.sizes)]
        self.words = Words(self.texts)
        self.window, self.buckets = window, buckets
        self.first, self.count, self.minimiser = self.words.paths(window)
        content = self.words.run_hash(self.first, self.first + self.count + window - 1)
        self.paths = Dealt(self.minimiser, content, bucket_of(self.minimiser, buckets), buckets)
        self.m, self.c, self.kinds, self.group = self.paths.by_minimiser()

    def questions(self) -> list[tuple]:
        starts = np.flatnonzero(np.diff(self.group, prepend=-1))
        return questions(self.block, 1, self.m, self.c, self.kinds, np.searchsorted(starts, self.paths.cuts))

    def _reply(self, parts: list[tuple[int, bytes]], n: int) -> np.ndarray:
        reply = np.frombuffer(b"".join(p for _, p in sorted(parts)), np.uint8)
        if len(reply) != n:
            raise RuntimeError(f"block {self.block}: {len(reply)} answers to {n} questions")
        return reply

    def opened(self, parts):
        """(which paths repeat whole, windows of the opened paths, those dealt out)."""
        reply = self._reply(parts, len(self.m))[self.group]  # of each distinct path
        whole = ((reply & WHOLE) > 0) | (self.paths.count > 1)
        own = self.paths.at[(reply & OPEN) > 0]
        n = self.count[own]
        windows = np.repeat(self.first[own], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        minimiser, content = np.repeat(self.minimiser[own], n), self.words.run_hash(windows, windows + self.window)
        dealt = Dealt(minimiser, content, bucket_of(minimiser ^ mixed(content), self.buckets), self.buckets)
        return whole[self.paths.number], windows, dealt

    def window_questions(self, parts) -> list[tuple]:
        _, _, d = self.opened(parts)
        return questions(self.block, 2, d.m, d.c, d.count, d.cuts)

    def removed(self, parts, window_parts) -> np.ndarray:
        """Which words are covered by a repeated window."""
        whole, windows, d = self.opened(parts)
        edges = np.zeros(self.words.n + 1, np.int64)
        np.add.at(edges, self.first[whole], 1)
        np.add.at(edges, self.first[whole] + self.count[whole] + self.window - 1, -1)
        repeated = windows[(self._reply(window_parts, len(d.m))[d.number] & WHOLE) > 0]
        np.add.at(edges, repeated, 1)
        np.add.at(edges, repeated + self.window, -1)
        return np.cumsum(edges[:-1]) > 0


def _blocks(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The documents in compressed blocks, written to the shared folder."""
    meta = F.to_json(F.struct(*keep)) if keep else F.lit(None).cast("string")

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        zstd = zstandard.ZstdCompressor(level=3)
        ids, texts, metas, size = [], [], [], 0

        def row():
            data = zstd.compress(b"".join(texts))
            return row_batch([(block, 0, -1, ids, [len(t) for t in texts], metas, data)])

        for batch in batches:
            new_ids, new, new_meta = batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist()
            for part in groups_of(new, BLOCK_BYTES // 4):
                ids += new_ids[part]
                texts += new[part]
                metas += new_meta[part]
                size += sum(map(len, new[part]))
                if size >= BLOCK_BYTES:
                    yield row()
                    block, ids, texts, metas, size = block + 1, [], [], [], 0
        if ids:
            yield row()

    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")]
    return written(docs.select(*columns, meta.alias("meta")).mapInArrow(run, ROWS), "substring-blocks")


def _asked(rows: DataFrame, step: int) -> DataFrame:
    """Answers to the questions, bucket by bucket."""

    def run(batches):
        bucket, held = None, []
        for batch in batches:
            blocks, buckets, payloads = (batch.column(k).to_pylist() for k in (0, 2, 6))
            for b, k, p in zip(blocks, buckets, payloads):
                if k != bucket and held:
                    yield row_batch(answers(step, held))
                    held = []
                bucket = k
                held.append((b, k, p))
        if held:
            yield row_batch(answers(step, held))

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, ROWS)


def _answered(blocks: DataFrame, *replies: DataFrame):
    """Blocks, each followed by its answers."""
    rows = blocks
    for r in replies:
        rows = rows.unionByName(r)
    return rows.repartition("block").sortWithinPartitions("block", "step", "bucket")


def _each_block(batches, window: int, buckets: int):
    """(block, answers to step 1, answers to step 2) from rows in order."""
    row, parts = None, ([], [])
    for batch in batches:
        for i in range(batch.num_rows):
            new = tuple(c[i].as_py() for c in batch.columns)
            if new[1] == 0:
                if row is not None:
                    yield Block(row, window, buckets), *parts
                row, parts = new, ([], [])
            elif row is None or new[0] != row[0]:
                raise RuntimeError(f"answers without block {new[0]}")
            else:
                parts[new[1] - 1].append((new[2], new[6]))
    if row is not None:
        yield Block(row, window, buckets), *parts


def remove_repeats(docs: DataFrame, window: int = 35, keep: tuple[str, ...] = (), buckets: int | None = None,
                   digest: bool = False, as_is: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, columns of ``keep``) of every row.

    ``kept`` is the kept words joined by one space; with ``digest``, kept_sha256 instead. With
    ``as_is``, a text that loses no word is kept as it is, white space too.
    """
    if window < K:
        raise ValueError(f"window must be at least {K}")
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = _blocks(docs, list(keep))

    def ask_paths(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield row_batch(Block(tuple(c[i].as_py() for c in batch.columns), window, buckets).questions())

    def ask_windows(batches):
        for block, parts, _ in _each_block(batches, window, buckets):
            yield row_batch(block.window_questions(parts))

    paths = written(_asked(blocks.mapInArrow(ask_paths, ROWS), 1), "substring-paths")
    asked = _answered(blocks, paths).mapInArrow(ask_windows, ROWS)
    windows = written(_asked(asked, 2), "substring-windows")
    last = "kept_sha256" if digest else "kept"
    names = ["doc_id", "n_words", "n_removed", last, "meta"]
    schema = f"doc_id bigint, n_words bigint, n_removed bigint, {last} string, meta string"
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def result(batches):
        for block, parts, window_parts in _each_block(batches, window, buckets):
            gone, w = block.removed(parts, window_parts), block.words
            out = []
            for i, (a, b) in enumerate(zip(w.before[:-1].tolist(), w.before[1:].tolist())):
                words, dropped = block.texts[i].split(), gone[a:b]
                n = int(dropped.sum())
                if n:
                    words = [words[k] for k in np.flatnonzero(~dropped)]
                kept = block.texts[i] if as_is and not n else b" ".join(words)
                kept = hashlib.sha256(kept).hexdigest() if digest else kept.decode()
                out.append((block.doc_ids[i], b - a, n, kept, block.meta[i]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    rows = _answered(blocks, paths, windows).mapInArrow(result, schema)
    if not keep:
        return rows.drop("meta")
    kind = T.StructType([docs.schema[c] for c in keep])
    meta = rows.withColumn("meta", F.from_json("meta", kind))
    return meta.select("doc_id", "n_words", "n_removed", last, *(F.col("meta")[c].alias(c) for c in keep))


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), digest=True)
