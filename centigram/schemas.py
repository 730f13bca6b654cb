"""Column names, table schemas and sample rows shared by the whole package."""

from pyspark.sql import types as T

# Measurements used for segmentation, in reporting order.
FEATURES = ("energy-kcal", "fat", "carbohydrates", "proteins", "sugars")

KEY = "code"
NAME = "product_name"
NESTED = "nutriments"
CLUSTER = "cluster"
VECTORS = ("features", "scaled_features")

# Training defaults.
DEFAULT_K = 5
DEFAULT_MAX_ITER = 20
DEFAULT_SEED = 42
DEFAULT_METHOD = "standard"
DEFAULT_OUTLIER_THRESHOLD = 3.0
DEFAULT_FILL_RATE = 0.5
DEFAULT_SAMPLE_PERCENT = 10
DEFAULT_EXTRACT_ROWS = 50_000
DEFAULT_BATCH_ROWS = 10
DEFAULT_SAMPLES_PER_CLUSTER = 5

# Fixed value: message of a finished run.
RUN_MESSAGE = "Clustering completed successfully"

RAW_PRODUCTS = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField(
            NAME,
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("lang", T.StringType()),
                        T.StructField("text", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField(
            NESTED,
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("100g", T.FloatType()),
                    ]
                )
            ),
        ),
    ]
)


def flat_products(features=FEATURES) -> T.StructType:
    """Key, name and one double per measurement."""
    return T.StructType(
        [T.StructField(KEY, T.StringType()), T.StructField(NAME, T.StringType())]
        + [T.StructField(f, T.DoubleType()) for f in features]
    )


def stored_products(features=FEATURES) -> T.StructType:
    return T.StructType(
        flat_products(features).fields + [T.StructField("created_at", T.TimestampType())]
    )


STORED_RESULTS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("cluster_id", T.IntegerType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("product_key", T.LongType()),
    ]
)

STORED_CENTERS = T.StructType(
    [
        T.StructField("cluster_id", T.IntegerType()),
        T.StructField("feature_name", T.StringType()),
        T.StructField("feature_value", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

CENTERS = T.StructType(
    [
        T.StructField(CLUSTER, T.IntegerType()),
        T.StructField("feature", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

CENTERS_MATRIX = T.StructType(
    [
        T.StructField("centers", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("featureNames", T.ArrayType(T.StringType())),
    ]
)

RUN_METRICS = T.StructType(
    [
        T.StructField("success", T.BooleanType()),
        T.StructField("message", T.StringType()),
        T.StructField("cluster_count", T.LongType()),
        T.StructField("silhouette_score", T.DoubleType()),
        T.StructField("cluster_sizes", T.MapType(T.StringType(), T.LongType())),
    ]
)

# The five smoke rows (code, name, then the measurements in order).
SAMPLE_PRODUCTS = (
    ("1", "Test Product 1", 100.0, 5.0, 10.0, 2.0, 5.0),
    ("2", "Test Product 2", 200.0, 10.0, 20.0, 5.0, 10.0),
    ("3", "Test Product 3", 300.0, 15.0, 30.0, 10.0, 15.0),
    ("4", "Test Product 4", 400.0, 20.0, 40.0, 15.0, 20.0),
    ("5", "Test Product 5", 500.0, 25.0, 50.0, 20.0, 25.0),
)
