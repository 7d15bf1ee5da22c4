"""Connected components by alternating large-star and small-star steps.

(Kiveris et al., "Connected Components in MapReduce and Beyond".) Every step is
an aggregation of minima, which combines before its shuffle, and a join back to
the edges, in which AQE splits a hot node. A round's edges are written to the
shared folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b): component is the smallest node reachable.

    Loops and repeated edges do no harm; null ends are left out.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = written(pairs, "components")
    state = _state(pairs)
    for _ in range(max_rounds):
        # large star: each node's larger neighbours point to the smallest of its neighbourhood
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = written(least, "components")  # a table of its own: AQE can split the join at a hot node
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "components")
        # small star: a node and its smaller neighbours point to the smallest of them
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "components")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        pairs = written(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "components")
        now = _state(pairs)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
