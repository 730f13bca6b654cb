"""Bounded, reproducible samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_label(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label): one row per document; repeated rows vote and a tie counts as 1."""
    return (
        labels.select("doc_id", F.col(column).cast("double").alias("v"))
        .where("doc_id IS NOT NULL AND v IN (0, 1)")
        .groupBy("doc_id")
        .agg((F.avg("v") >= 0.5).cast("int").alias("label"))
    )


def sample(stats: DataFrame, labels: DataFrame, limit: int):
    """About `limit` labelled rows at most, those whose hash of doc_id is low enough, as pandas.

    The hash thins the rows before the join, so no more than the sample reaches the driver.
    """
    total = labels.count()
    grain = 1 << 30
    share = min(grain, grain * limit // max(1, total))
    low = lambda df: df.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(grain)) < share)
    rows = low(stats).dropDuplicates(["doc_id"]).join(low(labels), "doc_id")
    return rows.orderBy("doc_id").toPandas()
