"""Rows and centre matrices as JSON text, and back."""

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from centigram.functions.columns import col
from centigram.schemas import CENTERS_MATRIX, CLUSTER, VECTORS

CORRUPT = "_corrupt_record"


def plain_columns(df: DataFrame, keep_vectors: bool = False) -> list[Column]:
    """Columns in a JSON-friendly form: vectors are dropped, or turned into arrays."""
    out = []
    for field in df.schema.fields:
        is_vector = isinstance(field.dataType, VectorUDT)
        if field.name in VECTORS and not keep_vectors:
            continue
        value = vector_to_array(col(field.name)) if is_vector else col(field.name)
        out.append(value.alias(field.name))
    return out


def rows_to_json(df: DataFrame, keep_vectors: bool = False) -> DataFrame:
    """One JSON object per row in column ``value``; every row, every field, NULLs included."""
    row = F.struct(*plain_columns(df, keep_vectors))
    return df.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("value"))


def rows_from_json(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON objects -> typed columns plus ``_corrupt_record`` (NULL for a readable row).

    A missing key is NULL; a list read into a string column keeps its ``[a,b]`` text.
    """
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # Generated, so that each line is parsed once for all of its columns.
    return lines.select(F.inline(F.array(F.from_json(col(column), full, options))))


def rows_from_responses(
    responses: DataFrame, schema: T.StructType, column: str = "value"
) -> DataFrame:
    """Rows of ``{"success": .., "message": .., "data": [..]}`` documents, one document per line.

    A document that does not report success, or cannot be read, fails the query.
    """
    envelope = T.StructType(
        [
            T.StructField("success", T.BooleanType()),
            T.StructField("message", T.StringType()),
            T.StructField("data", T.ArrayType(schema)),
        ]
    )
    parsed = responses.select(F.inline(F.array(F.from_json(col(column), envelope))))
    reason = F.coalesce(F.col("message"), F.lit("unreadable response"))
    failed = F.raise_error(F.concat(F.lit("request failed: "), reason))
    rows = F.when(F.col("success"), F.col("data")).otherwise(failed)
    return parsed.select(F.inline(rows))


def centers_to_json(centers: DataFrame, features) -> DataFrame:
    """Long centres (cluster, feature, value) -> one row ``{"centers": [[..]], "featureNames": [..]}``."""
    wide = centers.groupBy(CLUSTER).agg(
        F.array(
            *[F.max(F.when(F.col("feature") == f, F.col("value"))) for f in features]
        ).alias("center")
    )
    ordered = F.array_sort(F.collect_list(F.struct(CLUSTER, "center")))
    matrix = F.struct(
        F.transform(ordered, lambda c: c["center"]).alias("centers"),
        F.array(*[F.lit(f) for f in features]).alias("featureNames"),
    )
    return wide.agg(F.to_json(matrix).alias("value"))


def centers_from_json(lines: DataFrame, column: str = "value") -> DataFrame:
    """Centre matrices -> long rows (cluster, feature, value); clusters count from 0."""
    parsed = lines.select(F.from_json(col(column), CENTERS_MATRIX).alias("m"))
    by_center = parsed.select(
        F.col("m.featureNames").alias("names"), F.posexplode("m.centers").alias(CLUSTER, "center")
    )
    return by_center.select(
        CLUSTER,
        F.inline(F.arrays_zip(F.col("names").alias("feature"), F.col("center").alias("value"))),
    )
