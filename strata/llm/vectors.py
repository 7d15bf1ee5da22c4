"""Vectors in tasks: valid rows as numpy matrices, and rows of packed vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def is_valid(column: str) -> F.Column:
    """Whether a vector is not null, empty or zero and has only finite components; never null."""
    v = F.col(column).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))


def valid_vectors(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows with an id and a valid vector; v keeps single precision, else it is double."""
    found = rows.where(F.col("vec_id").isNotNull() & is_valid(column))
    kind = "array<float>" if rows.schema[column].dataType.simpleString() == "array<float>" else "array<double>"
    return found.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(column).cast(kind).alias("v"))


def matrices(batch, column: str = "v"):
    """(rows of the batch, their vectors as a double matrix) for each length of vector."""
    lists = batch.column(column)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, flat[starts[rows][:, None] + np.arange(d)].astype(np.float64)


def exact_distance(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distance of one vector to each row, in double precision, added up from the first component on."""
    return np.sqrt(np.cumsum((x - q) ** 2, axis=1)[:, -1])


def pieces(batches, rows: int):
    """The batches in slices of at most ``rows`` rows."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
