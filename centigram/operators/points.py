"""Measurements as matrices: what the row-by-cluster operators share.

A row meets every cluster, which array functions would do by interpreting a lambda for each pair.
Here the few cluster rows travel with the function and Arrow batches of rows meet them as numpy
blocks of bounded size.  Only the measurements leave the JVM, and the plan is the same for every k.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row

# Row-by-cluster distances that one block holds.
BLOCK = 1 << 19


def cluster_rows(groups: DataFrame, cluster: str, k: int) -> list[Row]:
    """The rows of a table with one row per cluster, by id; an id outside 0..k-1 is an error."""
    rows = groups.limit(k + 1).collect()
    if any(r[cluster] is None or not 0 <= r[cluster] < k for r in rows):
        raise ValueError(f"cluster id outside 0..{k - 1}")
    return sorted(rows, key=lambda r: r[cluster])


def matrix(columns: tuple[pa.Array, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Rows by features, and which rows lack a value."""
    points = np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns]).astype(np.float64)
    missing = np.zeros(len(points), bool)
    for c in columns:
        if c.null_count:
            missing |= c.is_null().to_numpy(zero_copy_only=False)
    return points, missing


def row_blocks(rows: int, clusters: int) -> Iterator[slice]:
    """Slices of rows that meet all clusters within BLOCK distances, a row at least."""
    step = max(1, BLOCK // max(1, clusters))
    for start in range(0, rows, step):
        yield slice(start, start + step)
