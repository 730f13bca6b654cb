"""Tables that describe a clustering."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from centigram.functions.columns import col, present, settled, with_row
from centigram.operators.quantiles import DEFAULT_ACCURACY, approximate_quantiles, exact_quantiles
from centigram.operators.sampling import first_per_group
from centigram.schemas import (
    CLUSTER,
    DEFAULT_SAMPLES_PER_CLUSTER,
    FEATURES,
    KEY,
    NAME,
    RUN_MESSAGE,
    RUN_METRICS,
    VECTORS,
)

# Whiskers reach this many interquartile ranges beyond the quartiles.
WHISKER = 1.5


def cluster_sizes(df: DataFrame, k: int | None = None, cluster: str = CLUSTER) -> DataFrame:
    """(cluster, size); with ``k`` also the empty clusters among 0..k-1."""
    rows = df.select(col(cluster).cast("int").alias(cluster), F.lit(1).alias("one"))
    if k is not None:
        ids = df.sparkSession.range(k)
        rows = rows.unionAll(ids.select(F.col("id").cast("int").alias(cluster), F.lit(0)))
    return rows.groupBy(cluster).agg(F.sum("one").alias("size"))


def cluster_share(sizes: DataFrame, cluster: str = CLUSTER) -> DataFrame:
    """Add ``share``: per cent of all rows, two decimals.  ``sizes`` has one row per cluster."""
    total = sizes.agg(F.sum("size").alias("_total"))
    share = F.round(F.col("size") / F.nullif("_total", F.lit(0)) * 100, 2)
    return with_row(sizes, total).select(
        cluster, "size", F.coalesce(share, F.lit(0.0)).alias("share")
    )


def cluster_distinct(df: DataFrame, cluster: str = CLUSTER) -> DataFrame:
    return df.agg(F.count_distinct(col(cluster)).alias("clusters"))


def cluster_samples(
    df: DataFrame,
    n: int = DEFAULT_SAMPLES_PER_CLUSTER,
    cluster: str = CLUSTER,
    key: str = KEY,
) -> DataFrame:
    """First ``n`` rows of each cluster by key, without vector columns; see first_per_group."""
    return first_per_group(df.drop(*VECTORS), cluster, n, key)


def cluster_means(df: DataFrame, features=FEATURES, cluster: str = CLUSTER) -> DataFrame:
    """One row per cluster, one mean per feature."""
    means = [F.avg(col(f)).alias(f) for f in present(df, features)]
    return df.groupBy(col(cluster).alias(cluster)).agg(*means)


def centers_long(wide: DataFrame, features=FEATURES, cluster: str = CLUSTER) -> DataFrame:
    """(cluster, feature, value) from one row per cluster."""
    return wide.unpivot(col(cluster), [col(f) for f in features], "feature", "value")


def centers_wide(
    long: DataFrame, features=FEATURES, cluster: str = CLUSTER, decimals: int = 2
) -> DataFrame:
    """One row per cluster, one rounded value per feature."""
    pivoted = long.groupBy(cluster).pivot("feature", list(features)).agg(F.first("value"))
    return pivoted.select(cluster, *[F.round(col(f), decimals).alias(f) for f in features])


def distribution_by_cluster(
    df: DataFrame,
    features=FEATURES,
    cluster: str = CLUSTER,
    accuracy: int = DEFAULT_ACCURACY,
    group_limit: int | None = None,
    exact: bool = True,
) -> DataFrame:
    """Box-plot table: n, min, quartiles, max, whiskers and outlier count per cluster and feature.

    Quartiles are exact, or from ``approximate_quantiles`` with ``exact=False`` and ``accuracy``;
    they are found when the function is called.  Whiskers are the outermost values within 1.5
    interquartile ranges of the box, and stop at the box if there are none beyond it.  Up to
    MAX_GROUPS boxes meet the rows by broadcast, more by a shuffle join.  ``group_limit`` is that
    of ``exact_quantiles``.
    """
    features = present(df, features)
    quartiles = (0.25, 0.5, 0.75)
    if exact:
        boxes = exact_quantiles(df, quartiles, features, cluster, group_limit=group_limit)
    else:
        boxes = approximate_quantiles(df, quartiles, features, cluster, accuracy)
    # One row per cluster again, to widen the rows without multiplying them.
    wide = boxes.groupBy("group").agg(
        *[
            F.max(F.when(F.col("feature") == f, F.col("quantiles"))).alias(f"q{i}")
            for i, f in enumerate(features)
        ]
    )
    values = df.select(col(cluster).alias("cluster"), *[col(f) for f in features])
    wide, small = settled(wide)
    wide = F.broadcast(wide) if small else wide
    rows = values.join(wide, values["cluster"].eqNullSafe(wide["group"])).drop("group")
    aggregates = []
    for i, f in enumerate(features):
        value, q1, q3 = col(f), F.col(f"q{i}")[0], F.col(f"q{i}")[2]
        reach = (q3 - q1) * WHISKER
        below, above = value < q1 - reach, value > q3 + reach
        aggregates += [
            F.count(value).alias(f"n{i}"),
            F.min(value).alias(f"min{i}"),
            F.max(value).alias(f"max{i}"),
            F.min(F.when(~below, value)).alias(f"lo{i}"),
            F.max(F.when(~above, value)).alias(f"hi{i}"),
            F.count_if(below | above).alias(f"out{i}"),
            F.first(F.col(f"q{i}")).alias(f"box{i}"),
        ]
    grouped = rows.groupBy("cluster").agg(*aggregates)
    entries = []
    for i, f in enumerate(features):
        q1, q2, q3 = (F.col(f"box{i}")[j] for j in range(3))
        entries.append(
            F.struct(
                F.lit(f).alias("feature"),
                F.col(f"n{i}").alias("n"),
                F.col(f"min{i}").alias("min"),
                q1.alias("q1"),
                q2.alias("median"),
                q3.alias("q3"),
                F.col(f"max{i}").alias("max"),
                F.least(F.col(f"lo{i}"), q1).alias("whisker_low"),
                F.greatest(F.col(f"hi{i}"), q3).alias("whisker_high"),
                F.col(f"out{i}").alias("outliers"),
            )
        )
    return grouped.select(F.col("cluster").alias(cluster), F.inline(F.array(*entries)))


def density_2d_by_cluster(
    df: DataFrame, x: str, y: str, bins: int = 50, cluster: str = CLUSTER
) -> DataFrame:
    """(cluster, bx, by, count): a binned scatter plot of two features, coloured by cluster."""
    ranges = [
        aggregate(col(f)).alias(f"{name}_{axis}")
        for axis, f in (("x", x), ("y", y))
        for name, aggregate in (("min", F.min), ("max", F.max))
    ]
    extent = df.agg(F.struct(*ranges).alias("e")).scalar()

    def bin_of(f: str, axis: str):
        low, high = extent[f"min_{axis}"], extent[f"max_{axis}"]
        width = (high - low) / bins
        place = F.least(F.floor((col(f) - low) / width), F.lit(bins - 1).cast("bigint"))
        return F.when(width > 0, place).otherwise(F.lit(0).cast("bigint"))

    placed = df.filter(col(x).isNotNull() & col(y).isNotNull()).select(
        col(cluster).alias(cluster), bin_of(x, "x").alias("bx"), bin_of(y, "y").alias("by")
    )
    return placed.groupBy(cluster, "bx", "by").agg(F.count(F.lit(1)).alias("count"))


def cluster_detail(
    shares: DataFrame,
    centers: DataFrame,
    samples: DataFrame,
    features=FEATURES,
    cluster: str = CLUSTER,
) -> DataFrame:
    """Report rows: size, share, rounded centre and the sample products of every cluster.

    One row per sample (``sample`` counts from 1; 0 for a cluster without rows); sample
    fields are text with 'N/A' where missing.  All inputs have a few rows per cluster.
    """
    center = centers_wide(centers, features, cluster, decimals=4)
    center = center.select(cluster, *[col(f).alias(f"center_{f}") for f in features])
    fields = present(samples, [KEY, NAME, *features])
    shown = samples.select(
        cluster, F.col("rank").alias("sample"), *[col(c).cast("string").alias(c) for c in fields]
    )
    joined = shares.join(center, cluster, "left").join(shown, cluster, "left")
    texts = {
        c: F.coalesce(col(c), F.lit("N/A")) if c in fields else F.lit("N/A")
        for c in [KEY, NAME, *features]
    }
    return joined.withColumns({"sample": F.coalesce("sample", F.lit(0)), **texts})


def run_metrics(
    sizes: DataFrame,
    silhouette: DataFrame,
    message: str = RUN_MESSAGE,
    cluster: str = CLUSTER,
) -> DataFrame:
    """One row: success, message, cluster_count, silhouette_score and sizes by cluster id."""
    entry = F.struct(F.col(cluster).cast("string").alias("id"), F.col("size"))
    metrics = sizes.agg(
        F.lit(True).alias("success"),
        F.lit(message).alias("message"),
        F.count(F.lit(1)).alias("cluster_count"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("cluster_sizes"),
    )
    scored = metrics.withColumn("silhouette_score", silhouette.select("silhouette").scalar())
    return scored.select(*RUN_METRICS.fieldNames())
