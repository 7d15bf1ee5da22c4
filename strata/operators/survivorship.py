"""Keyed survivorship: one row per dimension key, and the rows that lost.

Dimensions are de-duplicated by whole rows, so a key with two spellings keeps two
rows, and each of its orders would leave the joins twice.  ``survivors`` keeps one
by a stated rule, ``losing_rows`` keeps the others aside with the reason.

The winner is a maximum over a struct (the rules' values, then the row), so it is
an aggregation that combines map-side: a key that holds a third of the rows sends
one row per map task.  The losers are found by whole rows, not by key, so the rows
of such a key spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOST, NULL_KEY = "lost_to_survivor", "null_key"


def _has_key(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known


def survivors(df: DataFrame, keys: Sequence[str], prefer: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the row whose ``prefer`` values are largest, compared in order.

    A null value is the smallest, so ``F.col("name").isNotNull()`` prefers rows
    with a name and ``F.col("updated")`` the latest.  Ties go to the row with the
    largest columns, in column order, so the result depends on no partitioning.
    Rows whose key is null, or null in part, are no dimension rows and are left
    out (``losing_rows`` lists them).  Map columns cannot be compared.
    """
    if not keys:
        raise ValueError("survivors needs at least one key column")
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[p.alias(f"rule_{i}") for i, p in enumerate(prefer)],
                    F.struct(F.lit(0).alias("_"), *rest).alias("row"))
    best = df.where(_has_key(keys)).groupBy(*keys).agg(F.max(rank).alias("_best"))
    return best.select(*[F.col(f"_best.row.`{c}`").alias(c) if c in rest else F.col(c) for c in df.columns])


def losing_rows(df: DataFrame, winners: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct rows of ``df`` that ``winners`` (its survivors) left out, with the ``reason``."""
    rows, known = df.dropDuplicates(), _has_key(keys)
    lost = rows.where(known).subtract(winners.select(*df.columns)).withColumn("reason", F.lit(LOST))
    return lost.unionByName(rows.where(~known).withColumn("reason", F.lit(NULL_KEY)))
