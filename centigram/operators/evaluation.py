"""Silhouette with squared Euclidean distance.

The mean squared distance from a point to a whole cluster follows from the cluster's row
count, coordinate sums and sum of squared norms, so no pair of rows is ever formed.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centigram.functions.columns import col
from centigram.operators.points import cluster_rows, matrix, row_blocks
from centigram.schemas import CLUSTER, DEFAULT_K, FEATURES


def _squared_norm(features) -> Column:
    total = F.lit(0.0)
    for f in features:
        total = total + col(f) * col(f)
    return total


def cluster_moments(df: DataFrame, features=FEATURES, cluster: str = CLUSTER) -> DataFrame:
    """(cluster, n, spread, m0, m1, ..): count, mean squared norm and mean coordinates."""
    means = [F.avg(col(f)).alias(f"m{i}") for i, f in enumerate(features)]
    return df.groupBy(col(cluster).alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(_squared_norm(features)).alias("spread"), *means
    )


def silhouette_rows(
    df: DataFrame, k: int = DEFAULT_K, features=FEATURES, cluster: str = CLUSTER
) -> DataFrame:
    """``df`` plus ``silhouette``: NULL if only one cluster has rows, 0 for a lone member.

    A row without a value for a feature has none either.  The moments (at most ``k`` rows) are
    computed when the function is called; rows meet them in blocks of one matrix product each.
    """
    table = cluster_rows(cluster_moments(df, features, cluster), "cluster", k)
    ids = np.array([r["cluster"] for r in table], np.int64)
    n = np.array([r["n"] for r in table], np.float64)
    known = [[r[f"m{i}"] for i in range(len(features))] + [r["spread"]] for r in table]
    moments = np.array(known, np.float64).reshape(len(table), len(features) + 1)
    means, spread = moments[:, :-1], moments[:, -1]

    def block(points: np.ndarray, place: np.ndarray) -> np.ndarray:
        norms = (points * points).sum(axis=1)
        # Mean squared distance to all rows of each cluster.
        distance = np.maximum(norms[:, None] + spread - 2 * (points @ means.T), 0.0)
        row, size = np.arange(len(points)), n[place]
        # The row itself is among its cluster's n rows, at distance 0.
        inner = distance[row, place] * size / np.maximum(size - 1, 1)
        distance[row, place] = np.inf
        outer = np.fmin.reduce(distance, axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(inner > outer, outer / inner - 1.0, 1.0 - inner / outer)
        return np.where((size == 1) | (inner == outer), 0.0, score)

    def scores(label: pa.Array, *columns: pa.Array) -> pa.Array:
        points, missing = matrix(columns)
        if len(ids) < 2:
            return pa.nulls(len(points), pa.float64())
        place = np.searchsorted(ids, label.to_numpy(zero_copy_only=False))
        found = [block(points[s], place[s]) for s in row_blocks(len(points), len(ids))]
        return pa.array(np.concatenate([np.zeros(0), *found]), mask=missing)

    score = F.arrow_udf(scores, "double")
    inputs = [col(cluster).cast("bigint"), *[col(f).cast("double") for f in features]]
    return df.withColumn("silhouette", score(*inputs))


def silhouette_by_cluster(
    df: DataFrame, k: int = DEFAULT_K, features=FEATURES, cluster: str = CLUSTER
) -> DataFrame:
    """(cluster, size, silhouette): the mean over each cluster's rows."""
    rows = df.select(col(cluster), *[col(f) for f in features])
    return (
        silhouette_rows(rows, k, features, cluster)
        .groupBy(col(cluster).alias(cluster))
        .agg(F.count(F.lit(1)).alias("size"), F.avg("silhouette").alias("silhouette"))
    )


def silhouette_overall(by_cluster: DataFrame) -> DataFrame:
    """One row with the mean over all rows, from the per-cluster table."""
    weighted = F.sum(F.col("silhouette") * F.col("size")) / F.sum("size")
    return by_cluster.agg(weighted.alias("silhouette"))
