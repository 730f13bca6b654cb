import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw products from (code, names or None, measurements or None)."""
    from centigram.schemas import RAW_PRODUCTS

    def make(*rows):
        data = [
            (
                code,
                None if names is None else [("main", n) for n in names],
                None if values is None else list(values),
            )
            for code, names, values in rows
        ]
        return spark.createDataFrame(data, RAW_PRODUCTS)

    return make


@pytest.fixture
def numbers(spark):
    """Rows (key, cluster, x, y) used by the clustering tests."""

    def make(rows):
        return spark.createDataFrame(rows, "code string, cluster int, x double, y double")

    return make
