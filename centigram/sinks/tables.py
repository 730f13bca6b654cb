"""Stored tables and files."""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centigram.functions.columns import col, present
from centigram.functions.json_rows import rows_to_json
from centigram.functions.keys import product_id
from centigram.operators.quality import observed
from centigram.operators.sampling import head_by_key
from centigram.schemas import CLUSTER, DEFAULT_EXTRACT_ROWS, FEATURES, KEY, NAME
from centigram.sources.products import sample_products


# What Spark writes as %XX in the name of a partition's folder, control characters aside.
ESCAPED = "\"#%'*/:=?\\{[]^\x7f"


@dataclass(frozen=True)
class Loaded:
    """Rows that a load offered to a table and rows that it added, counted while it wrote.

    ``written`` is exact; ``offered`` may count rows again that a lost executor held (``observed``).
    """

    offered: int
    written: int


def table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None if nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def product_rows(df: DataFrame, features=FEATURES) -> DataFrame:
    """The stored-product columns this table has, plus the load time."""
    columns = present(df, [KEY, NAME, *features])
    return df.select(*[col(c) for c in columns]).withColumn("created_at", F.current_timestamp())


def result_rows(df: DataFrame, id_style: str = "code") -> DataFrame:
    """(product_id, cluster_id, created_at, product_key).

    ``product_id`` is text in every style, so runs of different styles share a table;
    ``product_key`` is the number of a numeric style, else NULL.
    """
    key = product_id(df, id_style)
    number = F.lit(None) if id_style == "code" else key
    return df.select(
        key.cast("string").alias("product_id"),
        col(CLUSTER).cast("int").alias("cluster_id"),
        F.current_timestamp().alias("created_at"),
        number.cast("bigint").alias("product_key"),
    )


def center_rows(centers: DataFrame) -> DataFrame:
    """(cluster_id, feature_name, feature_value, created_at); ids match the result rows."""
    return centers.select(
        F.col(CLUSTER).alias("cluster_id"),
        F.col("feature").alias("feature_name"),
        F.col("value").alias("feature_value"),
        F.current_timestamp().alias("created_at"),
    )


def new_rows(df: DataFrame, existing: DataFrame, key: str = KEY) -> DataFrame:
    """Rows whose key is not stored yet; rows without a key are always new."""
    keys = existing.select(col(key).alias("_key"))
    return df.join(keys, df[key] == keys["_key"], "left_anti")


def append_products(df: DataFrame, path: str, once: bool = True, features=FEATURES) -> Loaded:
    """Append product rows and say how many; with ``once`` a repeated load adds nothing.

    Each append reads the key column of the whole table.  Rows are compared with the stored
    table only: a code that comes twice in one load is stored twice.
    """
    rows, offered = observed(product_rows(df, features), "offered", ())
    existing = table_or_none(df.sparkSession, path) if once else None
    if existing is not None:
        rows = new_rows(rows, existing)
    rows, written = observed(rows, "written", ())
    rows.write.mode("append").parquet(path)
    return Loaded(offered.get["rows"], written.get["rows"])


def run_folder(path: str, run_id: str) -> str:
    """Where Spark keeps the partition of a run."""
    if not run_id:
        raise ValueError("a run needs a name")
    name = "".join(f"%{ord(c):02X}" if c < " " or c in ESCAPED else c for c in run_id)
    return f"{path}/run_id={name}"


def write_run(df: DataFrame, path: str, run_id: str, sort_by: str | None = None) -> int:
    """Write one run's rows under ``run_id=...``, replacing only that run's earlier rows, also by none.

    Returns the number of rows.  They are staged beside the table and take the earlier rows' place
    when all of them are written, so a run that fails leaves what was there; other runs may be
    written at the same time.  Only a driver lost while it moves the folder can leave a run without
    rows until it is written again.  ``sort_by`` orders each file by its lookup column, without a shuffle.
    """
    folder = run_folder(path, run_id)
    rows, written = observed(df, "written", ())
    rows = rows.withColumn("run_id", F.lit(run_id))
    rows = rows.sortWithinPartitions("run_id", col(sort_by)) if sort_by else rows
    replacing = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    replacing.partitionBy("run_id").parquet(path)
    count = written.get["rows"]
    if not count:
        # No row names the run, so nothing was replaced.
        df.limit(0).write.mode("overwrite").parquet(folder)
    return count


def write_results(df: DataFrame, path: str, run_id: str, id_style: str = "code") -> int:
    return write_run(result_rows(df, id_style), path, run_id, "product_id")


def write_centers(centers: DataFrame, path: str, run_id: str) -> int:
    return write_run(center_rows(centers), path, run_id, "cluster_id")


def write_jdbc(
    df: DataFrame, url: str, table: str, batch_size: int = 10_000, connections: int = 16, **options
) -> None:
    """Append to a JDBC table with at most ``connections`` parallel writers."""
    writer = df.write.format("jdbc").mode("append")
    writer.options(
        url=url, dbtable=table, batchsize=batch_size, numPartitions=connections, **options
    ).save()


def write_json_rows(
    df: DataFrame, path: str, max_rows: int | None = None, keep_vectors: bool = False
) -> None:
    """JSON lines of every row; ``max_rows`` is for previews only."""
    rows = df if max_rows is None else df.limit(max_rows)
    rows_to_json(rows, keep_vectors).write.mode("overwrite").text(path)


def write_word_counts(counts: DataFrame, path: str) -> None:
    """``word,count`` text lines."""
    counts.select("word", "count").write.mode("overwrite").csv(path)


def bounded_extract(
    df: DataFrame, path: str, n: int = DEFAULT_EXTRACT_ROWS, key: str | None = None
) -> None:
    """First ``n`` rows as zstd Parquet (in key order if a key is given), empty input included."""
    rows = head_by_key(df, n, key) if key else df.limit(n)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def seed_if_empty(spark: SparkSession, path: str, features=FEATURES) -> bool:
    """Append the smoke rows to a missing or empty product table; says whether it did."""
    existing = table_or_none(spark, path)
    if existing is not None and not existing.isEmpty():
        return False
    append_products(sample_products(spark, features), path, once=False, features=features)
    return True
