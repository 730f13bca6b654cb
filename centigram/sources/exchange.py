"""Row sets exchanged as JSON lines."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from centigram.functions.json_rows import CORRUPT, rows_from_json


def read_json_rows(
    spark: SparkSession, path: str, schema: T.StructType, strict: bool = True
) -> DataFrame:
    """JSON-lines rows under an explicit schema.

    ``strict`` fails on an unreadable line; otherwise it is kept, flagged in
    ``_corrupt_record``.
    """
    lines = spark.read.text(path)
    if not strict:
        return rows_from_json(lines, schema)
    full = spark.read.schema(schema).option("mode", "FAILFAST")
    return full.json(path)


__all__ = ["CORRUPT", "read_json_rows"]
