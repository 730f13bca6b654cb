"""Row rules, filters and data-quality reports.

Rules are plain conditions, so a filter and the report on it share one definition, and a
report on several rules is one pass.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from centigram.functions.columns import all_of, any_of, col, kept_rows, present, unpivot_row, with_row
from centigram.schemas import DEFAULT_FILL_RATE, DEFAULT_OUTLIER_THRESHOLD, FEATURES


def any_positive_rule(df: DataFrame, features=FEATURES) -> Column:
    """At least one available feature above zero; true if there are no features."""
    available = present(df, features)
    return any_of(col(f) > 0 for f in available) if available else F.lit(True)


def complete_rule(df: DataFrame, features=FEATURES) -> Column:
    """Every available feature is filled."""
    return all_of(col(f).isNotNull() for f in present(df, features))


def zscore_rule(
    df: DataFrame, features=FEATURES, threshold: float = DEFAULT_OUTLIER_THRESHOLD
) -> Column:
    """Every usable feature lies strictly within ``threshold`` standard deviations.

    Mean and deviation come from a scalar subquery over ``df``: one extra pass, one row,
    no join.  Features without a positive deviation are skipped.
    """
    available = present(df, features)
    if not available:
        return F.lit(True)
    moments = _moments(df, available)
    packed = moments.select(F.struct(*moments.columns).alias("row")).scalar()
    return _within(available, threshold, lambda name: packed[name])


def _moments(df: DataFrame, features) -> DataFrame:
    """One row: ``_mean<i>`` and ``_sd<i>`` per feature; no usable deviation is NULL."""
    moments = []
    for i, f in enumerate(features):
        sd = F.nullif(F.stddev_samp(col(f)), F.lit(0.0))
        moments += [F.avg(col(f)).alias(f"_mean{i}"), sd.alias(f"_sd{i}")]
    return df.agg(*moments)


def _within(features, threshold: float, stat: Callable[[str], Column] = F.col) -> Column:
    return all_of(
        F.coalesce(
            F.abs((col(f) - stat(f"_mean{i}")) / stat(f"_sd{i}")) < threshold,
            stat(f"_sd{i}").isNull(),
        )
        for i, f in enumerate(features)
    )


def any_positive(df: DataFrame, features=FEATURES) -> DataFrame:
    return kept_rows(df, any_positive_rule(df, features))


def complete_cases(df: DataFrame, features=FEATURES) -> DataFrame:
    """Rows with every available feature filled; NaN does not count as filled."""
    available = present(df, features)
    nan = {f: F.coalesce(F.isnan(col(f).try_cast("double")), F.lit(False)) for f in available}
    filled = all_of(col(f).isNotNull() & ~nan[f] for f in available)
    return kept_rows(df, filled) if available else df


def zscore_filter(
    df: DataFrame, features=FEATURES, threshold: float = DEFAULT_OUTLIER_THRESHOLD
) -> DataFrame:
    """Rows that meet ``zscore_rule``."""
    available = present(df, features)
    if not available:
        return df
    rows = with_row(df, _moments(df, available)).filter(_within(available, threshold))
    return rows.select(*[col(c) for c in df.columns])


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, and 0 for an empty whole."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def null_profile(df: DataFrame, features=FEATURES) -> DataFrame:
    """(feature, total, nulls, pct) from one pass."""
    available = present(df, features)
    nulls = [F.count_if(col(f).isNull()).alias(f"n{i}") for i, f in enumerate(available)]
    row = df.agg(F.count(F.lit(1)).alias("total"), *nulls)
    total = F.col("total")
    return unpivot_row(
        row,
        "feature",
        {
            f: {"total": total, "nulls": F.col(f"n{i}"), "pct": percent(F.col(f"n{i}"), total)}
            for i, f in enumerate(available)
        },
    )


def fill_rate(
    df: DataFrame, features=FEATURES, threshold: float = DEFAULT_FILL_RATE
) -> DataFrame:
    """(feature, filled, rate, keep): share of non-null values, and whether it is enough."""
    profile = null_profile(df, features)
    filled = F.col("total") - F.col("nulls")
    rate = F.when(F.col("total") > 0, filled / F.col("total")).otherwise(F.lit(0.0))
    return profile.select(
        "feature", filled.alias("filled"), rate.alias("rate"), (rate >= threshold).alias("keep")
    )


def well_filled(df: DataFrame, features=FEATURES, threshold: float = DEFAULT_FILL_RATE) -> list[str]:
    """Names of the features worth keeping (one row per feature reaches the driver)."""
    kept = {r["feature"] for r in fill_rate(df, features, threshold).collect() if r["keep"]}
    return [f for f in features if f in kept]


def kept_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, total, kept, removed, removed_pct) for any number of rules in one pass."""
    counts = [F.count_if(rule).alias(f"k{i}") for i, rule in enumerate(rules.values())]
    row = df.agg(F.count(F.lit(1)).alias("total"), *counts)
    total = F.col("total")
    return unpivot_row(
        row,
        "rule",
        {
            name: {
                "total": total,
                "kept": F.col(f"k{i}"),
                "removed": total - F.col(f"k{i}"),
                "removed_pct": percent(total - F.col(f"k{i}"), total),
            }
            for i, name in enumerate(rules)
        },
    )


def feature_stats(df: DataFrame, features=FEATURES) -> DataFrame:
    """(feature, mean, stddev) with the sample deviation, one pass."""
    available = present(df, features)
    aggregates = []
    for i, f in enumerate(available):
        aggregates += [F.avg(col(f)).alias(f"m{i}"), F.stddev_samp(col(f)).alias(f"s{i}")]
    entries = {
        f: {"mean": F.col(f"m{i}"), "stddev": F.col(f"s{i}")} for i, f in enumerate(available)
    }
    return unpivot_row(df.agg(*aggregates), "feature", entries)


def observed(df: DataFrame, name: str, features=FEATURES) -> tuple[DataFrame, Observation]:
    """``df`` plus counters filled in by whichever job reads it next: no job of their own.

    A stage that ends in a shuffle and runs again, as after a lost executor, counts its rows again;
    the stage that writes counts each row once.
    """
    seen = Observation(name)
    counters = [F.count_if(col(f).isNull()).alias(f"{f}_nulls") for f in present(df, features)]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counters), seen
