"""From raw product records to flat, filled measurement columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from centigram.functions.columns import col, present
from centigram.functions.measurements import first_text, measured
from centigram.operators.quality import well_filled, zscore_filter
from centigram.schemas import DEFAULT_OUTLIER_THRESHOLD, FEATURES, KEY, NAME, NESTED

PREFERENCES = ("flat", "nested", "row")


def cast_flat(df: DataFrame, features=FEATURES) -> DataFrame:
    """Flat features as doubles; text that is not a number becomes NULL."""
    return df.withColumns({f: col(f).try_cast("double") for f in present(df, features)})


def feature_column(df: DataFrame, feature: str, prefer: str = "flat") -> Column | None:
    """How to obtain one feature from this table, or None if it has no source.

    ``flat``: an existing column wins, the nested value is used only where there is no
    column.  ``nested``: the nested value wins whenever the table has the array.
    ``row``: the flat value, and the nested one in rows where it is NULL.
    """
    if prefer not in PREFERENCES:
        raise ValueError(f"prefer must be one of {PREFERENCES}")
    flat = col(feature).try_cast("double") if feature in df.columns else None
    nested = measured(feature) if NESTED in df.columns else None
    if flat is None or nested is None:
        return flat if nested is None else nested
    return {"flat": flat, "nested": nested, "row": F.coalesce(flat, nested)}[prefer]


def extract_features(
    df: DataFrame, features=FEATURES, prefer: str = "flat", keep: tuple = ()
) -> DataFrame:
    """Key, product name as text and the obtainable features, in one projection."""
    out = [col(KEY)] if KEY in df.columns else []
    if NAME in df.columns:
        is_array = isinstance(df.schema[NAME].dataType, T.ArrayType)
        out.append(first_text().alias(NAME) if is_array else col(NAME))
    for feature in features:
        column = feature_column(df, feature, prefer)
        if column is not None:
            out.append(column.alias(feature))
    return df.select(*out, *[col(c) for c in keep])


def fill_nulls(df: DataFrame, features=FEATURES, value: float = 0.0) -> DataFrame:
    """NULL and NaN measurements become ``value``."""
    available = present(df, features)
    return df.fillna({f: value for f in available}) if available else df


def prepare_features(
    df: DataFrame,
    features=FEATURES,
    prefer: str = "flat",
    remove_outliers: bool = False,
    outlier_threshold: float = DEFAULT_OUTLIER_THRESHOLD,
    keep: tuple = (),
    min_fill: float | None = None,
) -> DataFrame:
    """Extract, fill, optionally drop outliers; ``keep`` carries extra columns along.

    With ``min_fill`` only features with at least that share of filled rows stay, for which the
    input is read once more.
    """
    flat = extract_features(df, features, prefer, keep)
    if min_fill is not None:
        wanted = well_filled(flat, features, min_fill)
        flat = flat.select(*[col(c) for c in flat.columns if c not in features or c in wanted])
    flat = fill_nulls(flat, features)
    return zscore_filter(flat, features, outlier_threshold) if remove_outliers else flat


def rename_name_text(df: DataFrame) -> DataFrame:
    """Older extracts call the flattened name ``product_name_text``."""
    return df.withColumnRenamed("product_name_text", NAME)
