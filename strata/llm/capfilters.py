"""Embedding near-dedup (10): spherical-cap filters from random product codes.

After Becker, Ducas, Gama and Laarhoven (2016). A rotated vector is cut into two
parts, and each part has a code of ``CODE`` random directions; a filter is one
direction of each, so ``CODE ** 2`` filters need only ``2 * CODE`` inner products
(fewer where the parts have few dimensions).
List decoding finds every filter whose direction exceeds the cap, and vectors meet
in the filters they share, where cosines are verified in double precision. The cap
is set for each vector length (``cap_for``): over random pairs at exactly the
threshold's cosine, it is the strength that the best filter of a pair reaches with
probability ``FOUND``, so the cap alone finds that share of them; pairs of higher
cosine are found more often. The few vectors that exceed less than ``LEAST`` filters
(about 1 % at 64 dimensions) take their best ``LEAST``.

Equal vectors are merged first and stand for all their copies. A filter with
more than ``PART_ROWS`` vectors is split by vector, and every two parts meet in a
task of their own. In a task pairs are only counted: one row leaves a task for each
vector with links, with the number of links (a pair counts in the least filter
it shares, so once) and the least vector it reaches there; ``graph.components`` joins
these. So a large group of near copies is never written out as pairs. Vectors are
decoded twice, once to count the filters and once on their way to the tasks, so
what is stored and shuffled holds each vector once per filter.

Every row is a vector of its own, also where rows share an id: links are counted
between rows, and a component's id is the smallest id among its rows. Distinct
vectors are numbered in the order of their smallest id, and all work is done on
these numbers, so an id that holds very many vectors is no hot key.

Defined results: vectors that are null, empty, zero or not finite link with
nothing and are kept; vectors of different lengths do not link; rows of equal
vectors link to each other; rows without an id come back with a null id, 0 links
and kept false; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table, written
from strata.llm.graph import components
from strata.llm.vectors import is_valid, matrices, pieces, valid_vectors

CODE = 512
FOUND = 0.99  # share of pairs at the threshold that the cap finds
PAIRS = 400  # random pairs from which a cap is set
LEAST = 8  # filters of a vector that exceeds fewer
PART_ROWS = 1500
DECODED = 100  # vectors decoded at a time
HELD = 50_000  # linked vectors whose filters a task holds
MARGIN = 1e-5  # single-precision cosines nearer than this to the threshold are computed anew


class ProductCode:
    """Filters for vectors of one length."""

    def __init__(self, d: int, threshold: float, seed: int = 17):
        rng = np.random.default_rng(seed + d)
        self.size = d + d % 2
        self.n = min(CODE, 2 ** min(self.size // 2, 30))  # few dimensions have few directions that differ
        self.turn = np.linalg.qr(rng.normal(size=(self.size, self.size)))[0][:d]
        codes = rng.normal(size=(2, self.n, self.size // 2))
        self.codes = codes / np.linalg.norm(codes, axis=2, keepdims=True) / np.sqrt(2)
        self.cap = self.cap_for(threshold, rng)
        # the best LEAST sums of two sorted lists are among these places in them
        self.least = min(LEAST, self.n)
        self.places = np.array([(i, j) for i in range(self.least) for j in range(min(self.n, self.least // (i + 1)))])

    def strengths(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner products with the directions of each part; a filter's strength is the sum of its two."""
        turned, half = unit @ self.turn, self.size // 2
        return turned[:, :half] @ self.codes[0].T, turned[:, half:] @ self.codes[1].T

    def cap_for(self, threshold: float, rng) -> float:
        """The strength that the best common filter of random pairs at the threshold reaches with probability FOUND."""
        d = len(self.turn)
        x, z = rng.normal(size=(2, PAIRS, d))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        z -= (z * x).sum(axis=1, keepdims=True) * x
        z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-30)
        (xl, xr), (yl, yr) = (self.strengths(v) for v in (x, threshold * x + np.sqrt(1 - threshold**2) * z))
        best = [np.minimum(xl[k][:, None] + xr[k], yl[k][:, None] + yr[k]).max() for k in range(PAIRS)]
        return float(np.quantile(best, 1 - FOUND))

    def filters(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) pairs of unit vectors, in order of row and filter."""
        found = [self._filters(unit[i:i + DECODED], i) for i in range(0, len(unit), DECODED)]
        return np.divmod(np.concatenate([np.empty(0, np.int64), *found]), self.n**2)

    def _filters(self, unit: np.ndarray, first: int) -> np.ndarray:
        left, right = self.strengths(unit)
        r, a = np.nonzero(left + right.max(axis=1)[:, None] >= self.cap)
        i, b = np.nonzero(left[r, a][:, None] + right[r] >= self.cap)
        beyond = (r[i] + first) * self.n**2 + a[i] * self.n + b
        weak = np.flatnonzero(np.bincount(r[i], minlength=len(unit)) < self.least)
        if not len(weak):
            return beyond
        best = [np.argsort(-x[weak], axis=1, kind="stable")[:, :self.least] for x in (left, right)]
        a, b = best[0][:, self.places[:, 0]], best[1][:, self.places[:, 1]]
        sums = np.take_along_axis(left[weak], a, 1) + np.take_along_axis(right[weak], b, 1)
        top = np.argsort(-sums, axis=1, kind="stable")[:, :self.least]
        guard = np.take_along_axis(a * self.n + b, top, 1) + (weak + first)[:, None] * self.n**2
        return np.union1d(beyond, guard.ravel())


@lru_cache(maxsize=64)
def code_of(d: int, threshold: float) -> ProductCode:
    """A worker makes each length's code once."""
    return ProductCode(d, threshold)


def filters_of(x: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    return code_of(x.shape[1], threshold).filters(x / np.sqrt((x * x).sum(axis=1, keepdims=True)))


def least_labels(ids_a, ids_b, i, j):
    """Smallest id that each row reaches over the pairs (i of a, j of b), by repeated minima."""
    a, b = ids_a.copy(), ids_b.copy()
    while True:
        before = a.sum(), b.sum()
        np.minimum.at(a, i, b[j])
        np.minimum.at(b, j, a[i])
        if (a.sum(), b.sum()) == before:
            return a, b


def shared_before(filters: list[np.ndarray], filter_id: int, i, j) -> np.ndarray:
    """Which pairs of rows share a filter less than ``filter_id``."""
    own = [f[f < filter_id] for f in filters]
    known = np.unique(np.concatenate([np.empty(0, np.int64), *own]))
    bits = np.zeros((len(own), -(-max(1, len(known)) // 64)), np.uint64)
    for k, f in enumerate(own):
        at = np.searchsorted(known, f)
        np.bitwise_or.at(bits[k], at // 64, np.uint64(1) << (at % 64).astype(np.uint64))
    out = np.empty(len(i), bool)
    for x in range(0, len(i), 1 << 12):
        part = slice(x, x + (1 << 12))
        out[part] = (bits[i[part]] & bits[j[part]]).any(axis=1)
    return out


class Vectors:
    """Rows of one part: numbers, copies, side, vectors with their norms and single-precision unit vectors."""

    def __init__(self, node, copies, side, x):
        self.node, self.copies, self.side, self.x = node, copies, side, x
        self.norm = np.sqrt((x * x).sum(axis=1))
        self.unit = (x / self.norm[:, None]).astype(np.float32)

    def part(self, rows) -> "Vectors":
        out = object.__new__(Vectors)
        out.__dict__ = {n: v[rows] for n, v in self.__dict__.items()}
        return out

    @staticmethod
    def joined(parts: list["Vectors"]) -> "Vectors":
        out = object.__new__(Vectors)
        out.__dict__ = {n: np.concatenate([getattr(p, n) for p in parts]) for n in parts[0].__dict__}
        return out


def linked_pairs(a: Vectors, b: Vectors, threshold: float, same: bool):
    """(i, j) with cosine >= threshold, in double precision; with ``same`` (a is b) i < j."""
    c = a.unit @ b.unit.T
    near = c >= threshold - MARGIN
    if same:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    sure = c[i, j] >= threshold + MARGIN
    for x in np.flatnonzero(~sure):
        sure[x] = a.x[i[x]] @ b.x[j[x]] / (a.norm[i[x]] * b.norm[j[x]]) >= threshold
    return i[sure], j[sure]


def numbered(vectors: DataFrame) -> DataFrame:
    """(node, id, copies, v): distinct vectors, numbered in the order of their smallest id.

    The numbers are given once, as the table is written, and only read afterwards.
    """
    distinct = vectors.groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    distinct = written(distinct.withColumn("tie", F.xxhash64("v")), "cap-distinct")
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = distinct.repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie")
    return written(in_order.select(F.monotonically_increasing_id().alias("node"), "id", "copies", "v"), "cap-vectors")


def near_duplicates(rows: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``rows`` (vec_id, embedding)."""
    vectors = written(valid_vectors(rows), "cap-rows")
    distinct = numbered(vectors)
    kind = vectors.schema["v"].dataType.simpleString()

    def decode(batches):
        for batch in pieces(batches, 1000):
            for own, x in matrices(batch):
                r, f = filters_of(x, threshold)
                take = pa.array(own[r])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(r), x.shape[1], np.int32)), pa.array(f.astype(np.int32)),
                     *(batch.column(c).take(take) for c in ("node", "copies", "v"))], names=["dim", "filter", "node", "copies", "v"])

    def count(batches):
        for batch in pieces(batches, 1000):
            for _, x in matrices(batch):
                f, n = np.unique(filters_of(x, threshold)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(f), x.shape[1], np.int32)), pa.array(f.astype(np.int32)),
                                                  pa.array(n)], names=["dim", "filter", "n"])

    # at most CODE ** 2 rows a vector length; only the filters to be split are broadcast
    sizes = distinct.select("v").mapInArrow(count, "dim int, filter int, n bigint").groupBy("dim", "filter").agg(F.sum("n").alias("n"))
    sizes = sizes.select("dim", "filter", F.ceil(F.col("n") / PART_ROWS).cast("int").alias("parts")).where("parts > 1")
    sizes = F.broadcast(written(sizes, "cap-sizes"))
    met = distinct.mapInArrow(decode, f"dim int, filter int, node bigint, copies bigint, v {kind}")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    placed = met.join(sizes, ["dim", "filter"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    placed = placed.withColumn("part", part).withColumn("other", other).select(
        "dim", "filter", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"),
        (F.col("part") > F.col("other")).cast("int").alias("side"), "node", "copies", "v")

    def parts_of(batches):
        """(dim, filter, a, b) and rows of each stretch of equal keys; a key may go on in the next stretch."""
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(4)]
            cuts = (np.flatnonzero(np.any([np.diff(c) != 0 for c in columns], axis=0)) + 1).tolist()
            rows = [batch.column(c).to_numpy() for c in ("node", "copies", "side")]
            of_length = {x.shape[1]: (own, Vectors(*(r[own] for r in rows), x)) for own, x in matrices(batch)}
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a < b:
                    own, vectors = of_length[int(columns[0][a])]
                    first = int(np.searchsorted(own, a))
                    yield tuple(int(c[a]) for c in columns), vectors.part(slice(first, first + b - a))

    def compare(batches):
        decoded: dict[int, np.ndarray] = {}
        out = []
        for key, stretches in groupby(parts_of(batches), key=lambda p: p[0]):
            found = task(key, [v for _, v in stretches], decoded)
            if found:
                out.append(found)
            if len(out) >= 1000:
                yield made(out)
                out = []
        yield made(out)

    def made(out):
        columns = [np.concatenate([np.empty(0, np.int64), *(o[k] for o in out)]) for k in range(3)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "links", "label"])

    def task(key, held, decoded):
        """(numbers, links counted here, least number reached here) of the rows with links."""
        _, filter_id, a, b = key
        rows = held[0] if len(held) == 1 else Vectors.joined(held)
        if len(rows.node) < 2:
            return None
        if a == b:
            i, j = linked_pairs(rows, rows, threshold, True)
        else:
            left, right = np.flatnonzero(rows.side == 0), np.flatnonzero(rows.side == 1)
            i, j = linked_pairs(rows.part(left), rows.part(right), threshold, False)
            i, j = left[i], right[j]
        if not len(i):
            return None
        linked, at = np.unique(np.concatenate([i, j]), return_inverse=True)
        i, j = at[:len(i)], at[len(i):]
        node, copies = rows.node[linked], rows.copies[linked]
        labels, _ = least_labels(node, node, np.concatenate([i, j]), np.concatenate([j, i]))
        new = np.array([k for k, n in enumerate(node.tolist()) if n not in decoded], np.int64)
        if len(new):
            if len(decoded) > HELD:
                decoded.clear()
                new = np.arange(len(node))
            r, f = filters_of(rows.x[linked[new]], threshold)
            decoded.update(zip(node[new].tolist(), np.split(f, np.flatnonzero(np.diff(r)) + 1)))
        counted = ~shared_before([decoded[n] for n in node.tolist()], filter_id, i, j)
        i, j = i[counted], j[counted]
        links = np.zeros(len(node), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        return node, links, labels

    groups = placed.repartition("dim", "filter", "a", "b").sortWithinPartitions("dim", "filter", "a", "b")
    counted = written(groups.mapInArrow(compare, "node bigint, links bigint, label bigint"), "cap-links")
    links = counted.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(counted.select(F.col("node").alias("a"), F.col("label").alias("b"))).withColumnRenamed("component", "least")
    # a component's least number is its least id's
    linked = written(distinct.select("node", "id", "copies", "v").join(links, "node", "left").join(joined, "node", "left"), "cap-linked")
    names = distinct.select(F.col("node").alias("least"), F.col("id").alias("least_id"))
    merged = linked.join(names, "least", "left").select(
        F.col("v").alias("merged_v"), F.coalesce("least_id", "id").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    merged = written(merged, "cap-merged")
    # every row finds its vector's merged row again
    found = vectors.join(merged, vectors["v"] == merged["merged_v"]).select("vec_id", "n_links", "component")
    single = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    single = single.withColumn("valid", is_valid("embedding")).where("vec_id is null or not valid").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component"))
    return found.union(single).select(
        "vec_id", "n_links", F.col("component").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)).alias("kept"))


def op10_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
