"""Approximate nearest neighbours (1): balanced posting lists.

After SPANN (Chen et al., 2021). Centroids are fitted on the driver from a
bounded sample (``SAMPLE`` vectors, by a hash of the id) by balanced bisection;
their number follows the count of vectors up to ``MAX_LISTS``. Every vector is indexed: it goes to the list of its nearest
centroid and, as a boundary vector, to further lists whose centroid is hardly
farther (``BOUNDARY``), up to ``REPLICAS``. A query walks a graph of the
centroids in memory, best first, and reads every list whose centroid is at most
``RATIO`` times as far as the nearest one (distance-ratio pruning), but ``FEWEST``
lists at least, so small tables are searched whole. Vectors of selected lists are
compared exactly. Lists longer than ``PART_ROWS`` are split by
a hash, and a query reads all parts. Equal rows are one row from the start, and
wherever ``k`` is counted, ids are counted, not rows: a query's lists hold more
than ``k`` ids, and each part gives its ``k`` nearest ids, so an id with many
different vectors takes one place.

Defined results: vectors that are null, empty, zero or not finite, and rows
without an id, take no part; rows of one id are one candidate, with its smallest
distance; a query's own id is no candidate; equal distances go to the smaller
id; fewer candidates than ``k`` are all returned; vectors of other lengths than
the query's are no candidates; an empty table gives no rows; other columns are
left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import table, written
from strata.llm.vectors import exact_distance, matrices, pieces, valid_vectors

SAMPLE = 20_000  # vectors for fitting
MAX_LISTS = 2048
LIST_ROWS = 100  # vectors a list has until MAX_LISTS is reached
REPLICAS = 4
FEWEST = 8
BOUNDARY = 1.1  # a boundary vector's further centroids: at most so many times as far
RATIO = 1.12  # lists a query reads: centroids at most so many times as far as the nearest
PART_ROWS = 4000
HELD_QUERIES = 100_000  # queries whose nearest a task holds before it sends them on
DEGREE = 16  # neighbours of a centroid in the graph
BEAM = 32  # nearest centroids met whose neighbours are met too


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1), 0)


def fit_centroids(sample: np.ndarray, lists: int, seed: int = 3) -> np.ndarray:
    """At most ``lists`` centroids: the largest cluster is halved at a median, which keeps the lists balanced.

    Means steps afterwards would draw centroids together in the middle of dense
    clusters, and lists there grow long and alike (measured: less recall for more work).
    """
    rng = np.random.default_rng(seed)
    clusters = [np.arange(len(sample))]
    while len(clusters) < lists:
        clusters.sort(key=len)
        own = clusters.pop()
        x = sample[own]
        if len(own) < 2 or not np.ptp(x, axis=0).any():
            clusters.append(own)
            break
        far = x[((x - x[rng.integers(len(x))]) ** 2).sum(1).argmax()]
        other = x[((x - far) ** 2).sum(1).argmax()]
        order = np.argsort(x @ (far - other), kind="stable")
        clusters += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
    centroids = np.array([sample[c].mean(axis=0) for c in clusters])
    return np.unique(centroids, axis=0)


class CentroidGraph:
    """Nearest-neighbour graph of the centroids with best-first search for many queries at once."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids
        n = len(centroids)
        d = squared(centroids, centroids)
        self.near = np.argsort(d, axis=1, kind="stable")[:, 1 : DEGREE + 1]
        rng = np.random.default_rng(5)
        far = rng.integers(0, n, (n, 4))  # long edges keep the graph in one piece
        self.near = np.concatenate([self.near, far], axis=1)
        self.entry = int(d.sum(axis=1).argmin())

    def search(self, q: np.ndarray, ratio: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(distance to each centroid met, else inf; which are selected): all that are at most ``ratio``
        times as far as the nearest, and ``least`` at least. A centroid within the ratio, or among the
        nearest ``BEAM`` met, has its neighbours met; that widens the walk, not the selection."""
        n, m = len(q), len(self.c)
        dist = np.full((n, m), np.inf)
        opened = np.zeros((n, m), bool)
        dist[:, self.entry] = np.sqrt(squared(q, self.c[[self.entry]]))[:, 0]
        least, beam = min(least, m), min(max(least, BEAM), m)
        rows = np.arange(n)
        while len(rows):
            limit = dist[rows].min(axis=1) * ratio
            nth = np.partition(dist[rows], beam - 1, axis=1)[:, beam - 1]
            open_now = (dist[rows] <= np.maximum(limit, nth)[:, None]) & ~opened[rows] & np.isfinite(dist[rows])
            go = open_now.any(axis=1)
            r, c = np.nonzero(open_now)
            opened[rows[r], c] = True
            met = np.zeros((len(rows), m), bool)
            met[r[:, None], self.near[c]] = True
            met &= ~np.isfinite(dist[rows])
            r, c = np.nonzero(met)
            for i in range(0, len(r), 200_000):
                a, b = r[i : i + 200_000], c[i : i + 200_000]
                dist[rows[a], b] = np.sqrt(((q[rows[a]] - self.c[b]) ** 2).sum(axis=1))
            rows = rows[go]
        nth = np.partition(dist, least - 1, axis=1)[:, least - 1]
        return dist, (dist <= np.maximum(dist.min(axis=1) * ratio, nth)[:, None]) & np.isfinite(dist)


def lists_of(x: np.ndarray, graph: CentroidGraph) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, list, whether it is the row's nearest) of each vector's own and boundary lists."""
    rows, lists, first = [], [], []
    for i in range(0, len(x), 2000):
        dist, _ = graph.search(x[i : i + 2000], BOUNDARY, REPLICAS)
        order = np.argsort(dist, axis=1, kind="stable")[:, :REPLICAS]
        d = np.take_along_axis(dist, order, 1)
        for k in range(order.shape[1]):
            ok = np.isfinite(d[:, k]) & ((d[:, k] <= BOUNDARY * d[:, 0]) | (k == 0))
            r = np.flatnonzero(ok)
            rows.append(r + i)
            lists.append(order[r, k])
            first.append(np.full(len(r), k == 0))
    return np.concatenate(rows), np.concatenate(lists), np.concatenate(first)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query; both frames from ``valid_vectors``."""
    spark = vectors.sparkSession
    vectors = written(vectors.dropDuplicates(["vec_id", "v"]), "postings-vectors")
    queries = written(queries.dropDuplicates(["vec_id", "v"]), "postings-queries")
    sizes = {r["d"]: r["n"] for r in vectors.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
             .orderBy(F.desc("n")).limit(100).collect()}
    n = sum(sizes.values())
    place = F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = vectors.where(place < min(1.0, SAMPLE / max(1, n))).toArrow() if n else None
    graphs = {}
    if n and sample.num_rows == 0:
        sample = vectors.limit(1000).toArrow()
    if n:
        sample = sample.sort_by("vec_id")  # the rows' order after a shuffle differs from run to run
        for _, x in matrices(sample.combine_chunks().to_batches()[0]):
            lists = min(MAX_LISTS, max(1, sizes.get(x.shape[1], 0) // LIST_ROWS))
            graphs[x.shape[1]] = CentroidGraph(fit_centroids(x, lists))

    def graph_of(d: int) -> CentroidGraph:
        return graphs[d] if d in graphs else CentroidGraph(np.zeros((1, d)))

    keys = f"dim int, list int, first boolean, vec_id bigint, v {vectors.schema['v'].dataType.simpleString()}"

    def index(batches):
        for batch in batches:
            ids = batch.column("vec_id")
            for own, x in matrices(batch):
                rows, lists, first = lists_of(x, graph_of(x.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), x.shape[1], np.int32)), pa.array(lists.astype(np.int32)),
                     pa.array(first), ids.take(pa.array(own[rows])), batch.column("v").take(pa.array(own[rows]))], names=["dim", "list", "first", "vec_id", "v"])

    postings = written(vectors.mapInArrow(index, keys), "postings")
    # at most MAX_LISTS rows a vector length: bounded
    # n: rows; own: ids, each counted in one list only, so that lists together hold at least the sum
    homes = postings.where("first").groupBy("dim", "vec_id").agg(F.min("list").alias("list"))
    counts = postings.groupBy("dim", "list").agg(F.count("*").alias("n")).join(
        homes.groupBy("dim", "list").agg(F.count("*").alias("own")), ["dim", "list"], "left")
    counts = written(counts.select("dim", "list", "n", F.coalesce("own", F.lit(0)).alias("own")), "postings-counts")
    known = {(r["dim"], r["list"]): r["own"] for r in counts.collect()}
    parts = F.broadcast(counts.select("dim", "list", F.ceil(F.col("n") / PART_ROWS).cast("int").alias("parts")))

    def select(batches):
        for batch in pieces(batches, 1000):
            ids = batch.column("vec_id")
            for own, q in matrices(batch):
                d = q.shape[1]
                graph = graph_of(d)
                sizes_here = np.array([known.get((d, j), 0) for j in range(len(graph.c))])
                least = FEWEST
                while True:  # lists that hold more than k ids in all, if there are so many
                    dist, chosen = graph.search(q, RATIO, least)
                    if least >= len(graph.c) or (chosen @ sizes_here).min() > k:
                        break
                    least *= 4
                r, lists = np.nonzero(chosen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(r), d, np.int32)), pa.array(lists.astype(np.int32)),
                     pa.array(np.zeros(len(r), bool)), ids.take(pa.array(own[r])),
                     batch.column("v").take(pa.array(own[r]))],
                    names=["dim", "list", "first", "vec_id", "v"])

    asked = queries.mapInArrow(select, keys).join(parts, ["dim", "list"]).select(
        "dim", "list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("side"), "vec_id", "v")
    held = postings.join(parts, ["dim", "list"]).select(
        "dim", "list", F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")).cast("int").alias("part"),
        F.lit(0).alias("side"), "vec_id", "v")

    def nearest(ids, x, query_ids, q, best):
        """Adds a list's nearest ids to those that the task has for each query; ``ids`` in order."""
        starts = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))
        for i in range(0, len(q), 256):
            d2 = squared(q[i : i + 256], x)
            for j, row in enumerate(d2):
                query = int(query_ids[i + j])
                row = np.where(ids == query, np.inf, row)
                least = row if len(starts) == len(row) else np.minimum.reduceat(row, starts)  # of each id
                m = min(k, len(least))
                edge = np.partition(least, m - 1)[m - 1]
                near = np.flatnonzero((row <= edge * (1 + 1e-9) + 1e-9) & np.isfinite(row))
                score, found = exact_distance(q[i + j], x[near]), ids[near]
                if query in best:
                    score, found = np.concatenate([best[query][0], score]), np.concatenate([best[query][1], found])
                order = np.lexsort((found, score))
                order = order[np.sort(np.unique(found[order], return_index=True)[1])][:k]  # boundary vectors once
                best[query] = score[order], found[order]

    def flushed(best):
        sizes = [len(f) for _, f in best.values()]
        columns = [np.repeat(np.fromiter(best, np.int64, len(best)), sizes), *(
            np.concatenate([np.empty(0, t), *(x[n] for x in best.values())]) for n, t in ((1, np.int64), (0, np.float64)))]
        best.clear()
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    def scan(batches):
        key, x, ids, in_order, best = None, [], [], False, {}
        for batch in batches:
            dim, lists, part, side, vec = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(5))
            cuts = np.flatnonzero(np.any([np.diff(c) != 0 for c in (dim, lists, part, side)], axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(dim)]):
                if a == b:
                    continue
                now = (dim[a], lists[a], part[a])
                if now != key:
                    key, x, ids, in_order = now, [], [], False
                (_, v), = matrices(batch.slice(a, b - a))
                if side[a] == 0:
                    x.append(v)
                    ids.append(vec[a:b])
                elif x:
                    if len(x) > 1 or not in_order:
                        x, ids = np.concatenate(x), np.concatenate(ids)
                        order = np.argsort(ids, kind="stable")
                        x, ids, in_order = [x[order]], [ids[order]], True
                    nearest(ids[0], x[0], vec[a:b], v, best)
                    if len(best) > HELD_QUERIES:
                        yield flushed(best)
        yield flushed(best)

    rows = held.union(asked).repartition("dim", "list", "part").sortWithinPartitions("dim", "list", "part", "side")
    found = rows.mapInArrow(scan, "query_id bigint, vec_id bigint, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op1_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = valid_vectors(table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.where("vec_id % 100 = 0"))
