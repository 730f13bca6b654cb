"""Product-shaped inputs derived from the given tables.

``nested_products`` has arrays of structs with NULL arrays, missing entries, NULL values,
three spellings of one name and a duplicate entry whose first occurrence must win.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centigram.functions.columns import col
from centigram.operators.nested import prepare_features
from centigram.schemas import FEATURES

# Distance between two groups of ``separated_products`` in every feature.
APART = 10_000

CODE = "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)"

PRODUCT_NAME = """
CASE l_linenumber
  WHEN 7 THEN filter(array(named_struct('lang', 'main', 'text', p_name)), x -> false)
  WHEN 6 THEN NULL
  ELSE array(named_struct('lang', 'main', 'text', p_name),
             named_struct('lang', 'en', 'text', upper(p_name))) END
"""

NUTRIMENTS = """
CASE WHEN l_linenumber = 3 AND l_returnflag = 'A' THEN NULL
ELSE filter(array(
  named_struct('name', CASE l_returnflag WHEN 'A' THEN 'energy-kcal'
                       WHEN 'N' THEN 'energy kcal' ELSE 'energy_kcal' END,
               '100g', CAST(l_extendedprice / 100 AS FLOAT)),
  named_struct('name', IF(l_linenumber = 5, 'absent', 'fat'), '100g', CAST(l_quantity AS FLOAT)),
  named_struct('name', 'carbohydrates',
               '100g', IF(l_linenumber = 4, CAST(NULL AS FLOAT), CAST(p_size AS FLOAT))),
  named_struct('name', 'proteins', '100g', CAST(l_discount * 100 AS FLOAT)),
  named_struct('name', 'sugars', '100g', CAST(l_tax * 100 AS FLOAT)),
  named_struct('name', IF(l_linenumber = 2, 'sugars', 'absent'), '100g', CAST(999 AS FLOAT))
), x -> x.name <> 'absent') END
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def nested_products(spark: SparkSession, folder: str) -> DataFrame:
    """code, product_name (array), nutriments (array) and l_returnflag, one row per line item."""
    lines = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part")
    joined = lines.join(parts, lines["l_partkey"] == parts["p_partkey"])
    return joined.select(
        F.expr(CODE).alias("code"),
        F.expr(PRODUCT_NAME).alias("product_name"),
        F.expr(NUTRIMENTS).alias("nutriments"),
        "l_returnflag",
    )


def prepared_products(spark: SparkSession, folder: str) -> DataFrame:
    return prepare_features(nested_products(spark, folder))


def clustered_products(spark: SparkSession, folder: str) -> DataFrame:
    """Prepared products with a deterministic ``cluster`` (0, 1 or 2)."""
    prepared = prepare_features(nested_products(spark, folder), keep=("l_returnflag",))
    flag = F.col("l_returnflag")
    cluster = F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2)
    return prepared.withColumn("cluster", cluster).drop("l_returnflag")


def separated_products(spark: SparkSession, folder: str) -> DataFrame:
    """Products with flat columns in three groups so far apart that k-means must find them."""
    rows = clustered_products(spark, folder)
    moved = {f: col(f) + F.col("cluster") * APART for f in FEATURES}
    return rows.withColumns(moved).drop("cluster")
