"""Helpers for numeric work on bounded blocks of rows.

Spark partitions and shuffles the blocks; a task sees one pair of blocks at a time, each of limited size, and returns
aggregates or the best few matches - never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 2048


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """List column of equal lengths as a two-dimensional array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # an empty column keeps its chunks
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def array(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(d, 0.0)


def distances(a: np.ndarray, b: np.ndarray, step: int = 64) -> np.ndarray:
    """Distances by differences: slower than the product form, exact for near points."""
    out = np.empty((len(a), len(b)))
    for i in range(0, len(a), step):
        diff = a[i : i + step, None, :] - b[None, :, :]
        out[i : i + step] = np.sqrt((diff * diff).sum(2))
    return out


def numbered(df: DataFrame, keys: list[str], rows: int, block: str, count: str) -> DataFrame:
    """Spread the rows of each key evenly over blocks of about ``rows`` rows; ``count`` is their number."""
    sizes = df.groupBy(*keys).agg(F.ceil(F.count("*") / rows).cast("int").alias(count))
    return df.join(sizes, keys).withColumn(block, F.pmod(F.xxhash64("_id"), F.col(count)).cast("int"))


def cogroup(left: DataFrame, right: DataFrame, on: list[str], kernel, schema) -> DataFrame:
    """Co-group two frames; the right columns get identities of their own, so both may stem from one frame."""
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(kernel, schema)


def block_product(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    kernel: Callable[[tuple, pa.Table, pa.Table], pa.Table],
    schema: str,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Meet every block of ``left`` with every block of ``right`` of the same key.

    Both sides carry ``_id``. A hot key only has more blocks, so its work spreads over the cluster like any other.
    """
    a = numbered(left, keys, rows, "_lb", "_ln")
    b = numbered(right, keys, rows, "_rb", "_rn")
    n_left = a.select(*keys, "_ln").distinct()
    n_right = b.select(*keys, "_rn").distinct()
    a = a.join(n_right, keys).withColumn("_rb", F.explode(F.sequence(F.lit(0), F.col("_rn") - 1))).drop("_ln", "_rn")
    b = b.join(n_left, keys).withColumn("_lb", F.explode(F.sequence(F.lit(0), F.col("_ln") - 1))).drop("_ln", "_rn")
    on = [*keys, "_lb", "_rb"]
    return cogroup(a, b, on, kernel, schema)
