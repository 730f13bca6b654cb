"""Helpers that the corpus operators share: lineage cuts, Arrow batches, hashing, components.

A word is a maximal run outside the space and the control characters 9 to 13.  Python's
`bytes.split()` splits at exactly these six, and `bytes.lower()` folds exactly A-Z, so work
on UTF-8 bytes follows the contract without a pattern.
"""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one Arrow batch may carry, and rows at most.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 2_000


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches, so that a run of long texts does not meet in one batch."""
    for key, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        spark.conf.set(key, str(value))


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; only a local session without one gets a temporary one."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Store df through a reliable checkpoint, so that later steps do not compute it again.

    Shuffle files of steps that are stored by now go when the driver's JVM collects its
    garbage; asking for that keeps a long job's disk to what its last steps need.
    """
    shared_folder(df.sparkSession)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.checkpoint()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def texts(df: DataFrame) -> DataFrame:
    """(doc_id, text) with null texts as empty ones."""
    return df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def fold(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo; a null counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus))


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def batch_of(fields: dict[str, Any], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(fields[f.name], type=f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def slices(table: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for start in range(0, table.num_rows, rows):
        yield table.slice(start, rows)


def mix64(x: np.ndarray) -> np.ndarray:
    """The published splitmix64 finaliser on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grouped_count(df: DataFrame, rows_per_group: int) -> int:
    """How many groups of about rows_per_group rows df makes; at least one."""
    return max(1, -(-df.count() // rows_per_group))


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node reaches over edges (a, b).

    Labels fall along the edges and then along themselves (a label takes its own label's
    label), so that paths halve each round.  Every node hears its old label too, which comes from
    the labels and not with each edge; the labels serve both joins of a round from one shuffle.
    Minima are taken by partial aggregation; a node with very many neighbours stays one row a
    task.  The nodes' table is stored each round; the edges are read again, so pass stored ones.
    """
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    # Repeated edges do no harm to minima, so neither they nor the first labels cost a query of their own.
    both = edges.select("a", "b").where("a <> b").select(F.explode(ends).alias("e")).select("e.*")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("component"))
    for _ in range(limit):
        named = labels.select(F.col("node").alias("b"), "component")
        told = both.join(named, "b").select(F.col("a").alias("node"), F.col("component").alias("b"), F.lit(None).cast(labels.schema["component"].dataType).alias("old"))
        own = labels.select("node", F.col("component").alias("b"), F.col("component").alias("old"))
        heard = told.union(own).groupBy("node").agg(F.min("b").alias("b"), F.max("old").alias("old"))
        after = cut(heard.join(named, "b").select("node", "old", "component"))
        labels = after.select("node", "component")
        if after.where("component <> old").isEmpty():
            return labels
    raise RuntimeError("components did not settle")
