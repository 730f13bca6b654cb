"""Feature scaling, as columns and as ML stages."""

from pyspark.ml.feature import (
    MaxAbsScaler,
    MinMaxScaler,
    RobustScaler,
    StandardScaler,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centigram.functions.columns import col, with_row
from centigram.operators.quantiles import approximate_quantiles, exact_quantiles
from centigram.schemas import DEFAULT_METHOD, FEATURES

METHODS = ("standard", "minmax", "maxabs", "robust")


def assembler_stage(features=FEATURES, handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid=handle_invalid
    )


def scaler_stage(method: str = DEFAULT_METHOD):
    """Estimator for ``features`` -> ``scaled_features``.

    The ``robust`` stage takes approximate quartiles; ``scale_columns`` takes exact ones.
    """
    columns = {"inputCol": "features", "outputCol": "scaled_features"}
    if method == "standard":
        return StandardScaler(withMean=True, withStd=True, **columns)
    if method == "minmax":
        return MinMaxScaler(min=0.0, max=1.0, **columns)
    if method == "maxabs":
        return MaxAbsScaler(**columns)
    if method == "robust":
        return RobustScaler(withCentering=True, withScaling=True, **columns)
    raise ValueError(f"scaling method {method!r} is not one of {METHODS}")


def _parameters(df: DataFrame, features, method: str, exact: bool) -> DataFrame:
    """One row: centre ``_center<i>`` and width ``_width<i>`` per feature."""
    if method == "robust":
        quantiles = exact_quantiles if exact else approximate_quantiles
        quartiles = quantiles(df, (0.25, 0.5, 0.75), features)
        q = [
            F.max(F.when(F.col("feature") == f, F.col("quantiles"))).alias(f"q{i}")
            for i, f in enumerate(features)
        ]
        fields = []
        for i, _ in enumerate(features):
            box = F.col(f"q{i}")
            fields += [box[1].alias(f"_center{i}"), (box[2] - box[0]).alias(f"_width{i}")]
        return quartiles.agg(*q).select(*fields)
    measures = {
        "standard": lambda v: (F.avg(v), F.stddev_samp(v)),
        "minmax": lambda v: (F.min(v), F.max(v) - F.min(v)),
        "maxabs": lambda v: (F.lit(0.0), F.max(F.abs(v))),
    }
    if method not in measures:
        raise ValueError(f"scaling method {method!r} is not one of {METHODS}")
    aggregates = []
    for i, f in enumerate(features):
        center, width = measures[method](col(f))
        aggregates += [center.alias(f"_center{i}"), width.alias(f"_width{i}")]
    return df.agg(*aggregates)


def scale_columns(
    df: DataFrame,
    features=FEATURES,
    method: str = DEFAULT_METHOD,
    prefix: str = "scaled_",
    exact: bool = True,
) -> DataFrame:
    """Add ``<prefix><feature>`` columns; the parameters come from one aggregate row.

    ``exact=False`` lets the robust method take its quartiles from a sketch.

    A column without spread becomes 0 (0.5 for min-max).  NULL stays NULL.
    """
    flat = F.lit(0.5 if method == "minmax" else 0.0)
    scaled = []
    for i, f in enumerate(features):
        center, width = F.col(f"_center{i}"), F.col(f"_width{i}")
        usable = width.isNotNull() & (width != 0)
        value = F.when(usable, (col(f) - center) / width).otherwise(flat)
        scaled.append(F.when(col(f).isNotNull(), value).alias(prefix + f))
    fitted = with_row(df, _parameters(df, features, method, exact))
    return fitted.select(*[col(c) for c in df.columns], *scaled)


def vector_columns(
    df: DataFrame, features=FEATURES, vector: str = "scaled_features", prefix: str = "scaled_"
) -> DataFrame:
    """One double column per element of a vector column."""
    if vector not in df.columns:
        raise ValueError(f"no vector column {vector!r}")
    values = vector_to_array(col(vector))
    return df.withColumns({prefix + f: values[i] for i, f in enumerate(features)})
