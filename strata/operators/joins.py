"""Dimension joins at scale: size-checked broadcast, salted joins for hot keys."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.sinks import materialize

# Broadcast payload allowed by default: well below the driver's result-size
# limit and Spark's 8 GB broadcast ceiling, and small enough to copy to a
# thousand executors without dominating the stage.
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
MAX_PROBED_ROWS = 5_000_000
MIN_HOT_SHARE = 0.001  # so at most 1,000 keys of a column can be hot


def _row_bytes(schema: T.StructType) -> Column:
    """Upper estimate of one row's in-memory size (Spark's UnsafeRow layout):
    a null bitmap word per 64 fields, an 8-byte slot per field, and the
    variable-length part of strings, binaries and nested values rounded up to
    whole words."""
    n = len(schema.fields)
    fixed = 8 * ((n + 63) // 64) + 8 * n
    extra = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(c)
        elif isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18:
            size = F.lit(16)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(c))
        else:
            continue
        padded = size + 7 - F.pmod(size + 7, F.lit(8))
        extra.append(F.coalesce(padded, F.lit(0)))
    total = F.lit(fixed)
    for e in extra:
        total = total + e
    return total


def broadcast_if_bounded(df: DataFrame, max_rows: int,
                         max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only when it holds at most ``max_rows`` rows and about
    ``max_bytes`` bytes.

    Both bounds are measured, not estimated: one job takes at most
    ``max_rows + 1`` rows of ``df`` (``limit``) and returns their count and
    summed row size.  On a table, or a narrow plan over one, that reads a few
    rows however large the table is; a plan ending in a shuffle (a de-dup)
    has to run that shuffle to produce them, so probe the stored dimension
    table rather than the plan that builds it.  Beyond either
    bound the frame is returned unhinted and the join falls back to Spark's
    own choice (sort-merge with AQE skew splitting, or an AQE broadcast if
    the shuffled size turns out small).
    """
    if max_rows <= 0:
        return df
    if max_rows > MAX_PROBED_ROWS:  # the probe's limit gathers that many rows in one task
        raise ValueError(f"max_rows must be at most {MAX_PROBED_ROWS}, got {max_rows}")
    probe = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(_row_bytes(df.schema)), F.lit(0)).alias("bytes")).first()
    if probe["n"] <= max_rows and probe["bytes"] <= max_bytes:
        return F.broadcast(df)
    return df


SALT_COLUMN = "_salt"


def hot_keys(df: DataFrame, keys: Sequence[str], min_share: float = 0.01) -> dict[str, list]:
    """For each key column, its non-null values that hold at least ``min_share`` of the rows.

    One pass over ``df`` for all columns: every row gives one tagged row a
    column (its own slot set, each slot of its column's type), and partial
    counts reduce them before the shuffle.  The counts are stored once; the
    row total and the hot values come from them.  At most ``1 / min_share``
    values a column can qualify, and ``min_share`` has a floor, so the lists
    brought to the driver are bounded whatever the size of ``df``.
    """
    if not MIN_HOT_SHARE <= min_share <= 1:
        raise ValueError(f"min_share must be in [{MIN_HOT_SHARE}, 1], got {min_share}")
    slots = [f"k{i}" for i in range(len(keys))]
    types = [df.schema[k].dataType for k in keys]

    def tagged(i: int) -> Column:
        return F.struct(F.lit(i).alias("tag"), *[
            (F.col(keys[i]) if j == i else F.lit(None).cast(t)).alias(slots[j]) for j, t in enumerate(types)])

    counts = (df.select(F.explode(F.array(*[tagged(i) for i in range(len(keys))])).alias("r"))
              .select("r.*").groupBy("tag", *slots).count())
    counts = materialize(counts, "key-counts")
    total = counts.where("tag = 0").agg(F.sum("count")).first()[0]
    found: dict[str, list] = {k: [] for k in keys}
    if total:
        threshold = max(1, math.ceil(min_share * total))
        for r in counts.where(F.col("count") >= threshold).collect():
            if r[slots[r["tag"]]] is not None:
                found[keys[r["tag"]]].append(r[slots[r["tag"]]])
    return found


def salted_left_join(fact: DataFrame, dim: DataFrame, key: str, hot: list, buckets: int) -> DataFrame:
    """``fact LEFT JOIN dim USING (key)`` with hot keys spread over ``buckets`` tasks.

    Fact rows whose key is hot, or null, get a salt in ``[0, buckets)`` from a
    hash of the whole row (deterministic, so a retried task sends every row
    to the same place); all other rows get salt 0.  Dimension rows of hot
    keys are repeated once per salt, all others carry salt 0, and the join
    runs on ``(key, salt)``.  The result is the plain left join's: each fact
    row meets exactly the dimension rows of its key.  Only hot dimension rows
    are copied, so the dimension grows by ``len(hot) * (buckets - 1)`` rows.
    Works with AQE off; with AQE on it complements the skew-join split.
    """
    if buckets < 2:
        return fact.join(dim, key, "left")
    k = F.col(key)
    spread = k.isNull() | (k.isin(list(hot)) if hot else F.lit(False))
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns])
    salted = fact.withColumn(
        SALT_COLUMN, F.when(spread, F.pmod(row_hash, F.lit(buckets))).otherwise(F.lit(0)).cast("int"))
    if hot:
        copies = F.when(F.col(key).isin(list(hot)), F.sequence(F.lit(0), F.lit(buckets - 1)))
        dim = dim.withColumn(SALT_COLUMN, F.explode(copies.otherwise(F.array(F.lit(0)))))
    else:
        dim = dim.withColumn(SALT_COLUMN, F.lit(0))
    return salted.join(dim, [key, SALT_COLUMN], "left").drop(SALT_COLUMN)
