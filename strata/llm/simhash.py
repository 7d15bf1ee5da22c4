"""SimHash near-dedup (5): tiled exact comparison of 64-bit fingerprints.

Fingerprints are computed in tasks (XXH64 of word shingles, one vote a bit),
and equal ones are merged by an aggregation. Tiles hold the distinct
fingerprints of one population-count signature: the counts of set bits in each
quarter of the fingerprint. Two fingerprints within the radius have signatures
within the same distance, so each tile meets only those whose counts differ by
no more than the radius in all; all other pairs of tiles are skipped. A pair of
tiles is compared with numpy exclusive-or and bit counts, exactly. A tile of more
than ``tile_rows`` is split by a hash and each part meets the same neighbours, so
no task holds more than that. Links join into groups by ``graph.components``.

Defined results: a text without words (or null) has fingerprint zero and links
like any other; fewer words than a shingle: the whole sequence is one; repeated
rows link to each other; rows with a null id are fingerprinted, and a group's id
is its smallest id that is not null (null if it has none); an empty table gives
no rows; other columns are left out.
"""

from __future__ import annotations

from itertools import product, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import table, utf8, written
from strata.llm.graph import components

PARTS = 4  # signature: set bits in each of four 16-bit parts
PART_BITS = 64 // PARTS


def shingle_hashes(text: bytes, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle, repeats included."""
    w = text.lower().split()
    if not w:
        return np.empty(0, np.uint64)
    shingles = map(b" ".join, zip(*(w[k:] for k in range(words)))) if len(w) >= words else [b" ".join(w)]
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes."""
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        part = hashes[i : i + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns of ``keep`` and fp, the signed 64-bit fingerprint of the whole text."""
    schema = T.StructType([*docs.select(*keep).schema, T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            fps = [fingerprint(shingle_hashes(t, words)) for t in utf8(batch.column(0))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fps, pa.int64())], names=[*keep, "fp"])

    return docs.select(F.col("text").cast("string").alias("_text"), *keep).mapInArrow(run, schema)


def signature(fp) -> F.Column:
    """The tile's number: one digit a part, the part's set bits."""
    base = PART_BITS + 3  # room for a neighbour's digit beyond 16
    digits = [F.bit_count(F.shiftrightunsigned(fp, PART_BITS * k).bitwiseAND(F.lit((1 << PART_BITS) - 1)))
              for k in range(PARTS)]
    return sum((d.cast("bigint") * base**k for k, d in enumerate(digits)), F.lit(0).cast("bigint"))


def neighbour_steps(radius: int) -> list[int]:
    """Signature differences to meet: counts that differ by up to ``radius`` in all; one of each opposite two."""
    base = PART_BITS + 3
    steps = [s for s in product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, s)) <= radius]
    return [sum(x * base**k for k, x in enumerate(s)) for s in steps if s >= (0,) * PARTS]


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int, cells: int = 1 << 22):
    """Index pairs (i, j) with at most ``radius`` differing bits, a block of cells at a time."""
    rows = max(1, cells // max(1, len(a)))
    for j in range(0, len(b), rows):
        i, k = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, j : j + rows]) <= radius)
        if len(i):
            yield i, j + k


def links(fps: DataFrame, radius: int = 2, tile_rows: int = 200_000) -> DataFrame:
    """(a, b) of distinct fingerprints (column fp) that differ in at most ``radius`` bits, a < b."""
    if radius > 3:
        raise ValueError("signatures have room for a radius of up to 3")
    keyed = fps.select("fp", signature(F.col("fp")).alias("tile"))
    # at most 17 ** 4 tiles, whatever the input: bounded, so it may be broadcast
    tiles = keyed.groupBy("tile").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("parts"))
    tiles = F.broadcast(written(tiles, "simhash-tiles"))
    own = keyed.join(tiles, "tile").select(
        "tile", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part"), F.lit(0).alias("side"), "fp")
    met = keyed.select("fp", F.explode(F.array([F.col("tile") + F.lit(s) for s in neighbour_steps(radius)])).alias("tile"))
    met = met.join(tiles, "tile").select(
        "tile", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("side"), "fp")

    def run(batches):
        key, held = None, []  # the tile's own rows come first
        base = None

        def pairs(other):
            for i, j in close_pairs(base, other, radius):
                x, y = base[i].view(np.int64), other[j].view(np.int64)
                # within one tile a pair is met twice, and each row meets itself
                same = sig_of(x) == sig_of(y)
                keep = ~same | (x < y)
                x, y = x[keep], y[keep]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

        for batch in batches:
            tile, part, side, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            fp = fp.view(np.uint64)
            cuts = np.flatnonzero((np.diff(tile) != 0) | (np.diff(part) != 0) | (np.diff(side) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(tile)]):
                if a == b:
                    continue
                if (tile[a], part[a]) != key:
                    key, held, base = (tile[a], part[a]), [], None
                if side[a] == 0:
                    held.append(fp[a:b])
                elif held:
                    base = np.concatenate(held) if base is None else base
                    yield from pairs(fp[a:b])

    rows = own.union(met).repartition("tile", "part").sortWithinPartitions("tile", "part", "side")
    return rows.mapInArrow(run, "a bigint, b bigint")


def sig_of(fps: np.ndarray) -> np.ndarray:
    """Signature of each fingerprint, in numpy."""
    parts = np.bitwise_count(np.ascontiguousarray(fps).view(np.uint16).reshape(-1, PARTS)).astype(np.int64)
    return parts @ (PART_BITS + 3) ** np.arange(PARTS)


def grouped(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, component_id) of every fingerprint in ``rows`` (doc_id, fp): its group's smallest id."""
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    joined = components(links(distinct, radius))
    member = distinct.join(joined, distinct["fp"] == joined["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    member = written(member, "simhash-members")
    smallest = member.groupBy("component").agg(F.min("first").alias("component_id"))
    return written(member.join(smallest, "component").select("fp", "component_id"), "simhash-ids")


def simhash_groups(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id) of every row."""
    rows = written(fingerprints(docs.withColumn("doc_id", F.col("doc_id").cast("bigint")), words), "simhash")
    return rows.join(grouped(rows, radius), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs``, one of each group: the smallest id's (of several such rows, any one)."""
    # the row travels as one column, whatever its columns are called
    rows = docs.select("text", "doc_id", F.struct(*docs.columns).alias("doc"))
    rows = fingerprints(rows, words, ("doc_id", "doc")).withColumn("_row", F.monotonically_increasing_id())
    rows = written(rows, "simhash-rows")  # rows are numbered once and for all
    order = F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id").cast("bigint").alias("id"), F.col("_row").alias("row"))
    # groups by row number, so that rows without an id or with one id are told apart
    numbered = rows.select(F.col("_row").alias("doc_id"), "fp")
    group = grouped(numbered, radius).withColumnRenamed("component_id", "group")
    first = rows.select("doc_id", "_row", "fp").groupBy("fp").agg(F.min(order).alias("first"))
    kept = first.join(group, "fp").groupBy("group").agg(F.min("first").alias("first"))
    kept = written(kept.select(F.col("first")["row"].alias("_row")), "simhash-kept")
    # the kept row numbers grow with the documents: dealt out, never broadcast, at every size
    return rows.join(kept.hint("shuffle_hash"), "_row", "left_semi").select("doc.*")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))
