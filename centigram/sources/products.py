"""Product sources.  Every reader applies the same projection."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from centigram.functions.columns import col, present
from centigram.schemas import FEATURES, KEY, NAME, NESTED, SAMPLE_PRODUCTS, flat_products


def wanted_columns(df: DataFrame, features=FEATURES) -> list[str]:
    """Key, name, nested measurements and flat features, as far as the source has them."""
    return present(df, dict.fromkeys([KEY, NAME, NESTED, *features]))


def read_products(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    features=FEATURES,
    schema: T.StructType | None = None,
    infer: bool = False,
) -> DataFrame:
    """Products from Parquet, tab-separated CSV with a header, or JSON lines.

    Only the wanted columns are kept, so Parquet reads no others.  CSV and JSON take an
    explicit ``schema``; ``infer`` asks Spark to read the input once more to guess it.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "csv":
        reader = spark.read.option("sep", "\t").option("header", True)
        if schema:
            # The header must name the schema's columns in the same order.
            reader = reader.schema(schema).option("enforceSchema", False)
        else:
            reader = reader.option("inferSchema", infer)
        df = reader.csv(path)
    elif fmt == "json":
        reader = spark.read.schema(schema) if schema else spark.read
        if not schema and not infer:
            raise ValueError("JSON needs a schema, or infer=True")
        df = reader.json(path)
    else:
        raise ValueError(f"no reader for format {fmt!r}")
    return df.select(*[col(c) for c in wanted_columns(df, features)])


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **connection: str,
) -> dict[str, str]:
    """Reader options; with a numeric ``partition_column`` the read runs in parallel."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **connection}
    if partition_column is not None:
        if None in (lower, upper, partitions):
            raise ValueError("a partitioned read needs lower, upper and partitions")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def read_table(
    spark: SparkSession, table: str, fmt: str = "parquet", options: dict | None = None
) -> DataFrame:
    """A whole stored table: a Parquet folder, a catalogue table, or a JDBC table."""
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**{"dbtable": table, **(options or {})}).load()
    if fmt == "catalog":
        return spark.table(table)
    return spark.read.format(fmt).options(**(options or {})).load(table)


def sample_products(spark: SparkSession, features=FEATURES) -> DataFrame:
    """The five smoke rows under the given feature names."""
    if len(features) != len(FEATURES):
        raise ValueError(f"the sample has exactly {len(FEATURES)} measurements")
    return spark.createDataFrame(list(SAMPLE_PRODUCTS), flat_products(features))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files as one ``value`` per line."""
    return spark.read.text(path)
