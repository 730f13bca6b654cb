"""Exact quantiles per group that never hold a group in one task.

``percentile`` keeps every distinct value of a group in one buffer.  Here one pass counts the
values of every part (group and feature) in buckets of nearly equal ratio; running counts tell
which buckets hold the wanted ranks.  A bucket with a single value is settled at once.  The
values of the other chosen buckets, and only they, are counted in a second pass, cut into
bins between the bucket's least and greatest value, and the bins that hold a rank are sorted.
Nothing is estimated, so no rank can be missed.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from centigram.functions.columns import any_of, col, present, settled
from centigram.schemas import FEATURES

# Error bound of ``approximate_quantiles``: ranks are off by at most one row in so many.
DEFAULT_ACCURACY = 10_000

# Buckets for every doubling of the absolute value.
DEFAULT_STEPS = 1024

# Above the logarithm (base 2) of any double, without sign.
LARGEST_POWER = 1100

# Equal-width cuts of a bucket.
BINS = 4096

# Chosen buckets that the driver may hold; more are joined by shuffle.
MOST_BUCKETS = 50_000


def _bucket(value: Column, steps: int) -> Column:
    """A number that never falls as the value rises; NaN is with the greatest."""
    size = F.floor((F.log2(F.abs(value)) + LARGEST_POWER) * steps)
    return (
        F.when(F.isnan(value), F.lit(2**63 - 1))
        .when(value > 0, size)
        .when(value < 0, -size)
        .otherwise(F.lit(0).cast("bigint"))
    )


def _values(df: DataFrame, features, group: str | None, steps: int) -> DataFrame:
    """(group, feature, value, bucket): one row per non-null value; ``feature`` is a position."""
    keys = [col(group).alias("group")] if group else []
    entries = [
        F.struct(F.lit(i).alias("feature"), col(f).cast("double").alias("value"))
        for i, f in enumerate(features)
    ]
    long = df.select(*keys, F.inline(F.array(*entries))).filter(F.col("value").isNotNull())
    return long.withColumn("bucket", _bucket(F.col("value"), steps))


def _running(df: DataFrame, parts, order, amount: str) -> DataFrame:
    """Add ``before``: the sum of ``amount`` over the rows ahead in each part."""
    ahead = Window.partitionBy(*parts).orderBy(*order)
    return df.withColumn("before", F.sum(amount).over(ahead) - F.col(amount))


def _holds(index: Column, amount: str) -> Column:
    return (F.col("before") <= index) & (index < F.col("before") + F.col(amount))


def _join(left: DataFrame, right: DataFrame, names) -> DataFrame:
    """Equi-join in which NULL keys match."""
    right = right.withColumnsRenamed({n: f"_{n}" for n in names})
    same = [left[n].eqNullSafe(right[f"_{n}"]) for n in names]
    return left.join(right, same).drop(*[f"_{n}" for n in names])


def _inside(values: DataFrame, chosen: DataFrame, part, wanted) -> DataFrame:
    """(part, n, before, copies, value): the values near the wanted ranks in ``chosen`` buckets."""
    within = [*part, "bucket", "n", "start", "slot"]
    share = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low"))
    slot = F.least(F.floor(share * BINS), F.lit(BINS - 1).cast("bigint"))
    buckets = chosen.withColumnRenamed("before", "start").drop("size")
    counted = (
        _join(values, buckets, [*part, "bucket"])
        .withColumn("slot", slot)
        .groupBy(*within, "value")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    # At most BINS slots per bucket: a short window, whatever the size of the group.
    slots = _running(
        counted.groupBy(*within).agg(F.sum("copies").alias("size")), [*part, "bucket"], ["slot"], "size"
    ).withColumn("before", F.col("before") + F.col("start"))
    held = slots.filter(any_of(_holds(rank, "size") for rank in wanted))
    held = held.select(*part, "bucket", "slot", F.col("before").alias("ahead"))
    ordered = _running(
        _join(counted, held, [*part, "bucket", "slot"]), [*part, "bucket", "slot"], ["value"], "copies"
    )
    return ordered.select(
        *part, "n", (F.col("before") + F.col("ahead")).alias("before"), "copies", "value"
    )


def exact_quantiles(
    df: DataFrame,
    probabilities,
    features=FEATURES,
    group: str | None = None,
    steps: int = DEFAULT_STEPS,
    group_limit: int | None = None,
) -> DataFrame:
    """(group, feature, n, quantiles): linearly interpolated, ignoring NULLs.

    The first pass runs when the function is called.  Up to MOST_BUCKETS chosen buckets reach
    the second pass by broadcast, more by a shuffle join; any number of groups will do.  With
    ``group_limit`` more groups are an error.  More ``steps`` leave less to the second pass and
    count more buckets.  Values are compared as doubles.
    """
    features, probabilities = present(df, features), [float(p) for p in probabilities]
    part = ["group", "feature"] if group else ["feature"]
    places = [(F.col("n") - 1) * F.lit(p) for p in probabilities]
    wanted = [rank for place in places for rank in (F.floor(place), F.ceil(place))]

    values = _values(df, features, group, steps)
    value = F.col("value")
    buckets = values.groupBy(*part, "bucket").agg(
        F.count(F.lit(1)).alias("size"), F.min(value).alias("low"), F.max(value).alias("high")
    )
    total = F.sum("size").over(Window.partitionBy(*part))
    ranked = _running(buckets.withColumn("n", total), part, ["bucket"], "size")
    chosen, small = settled(ranked.filter(any_of(_holds(r, "size") for r in wanted)), MOST_BUCKETS)
    if group and group_limit is not None:
        if len(chosen.select("group").distinct().take(group_limit + 1)) > group_limit:
            raise ValueError(f"more than {group_limit} groups; pass a larger limit")

    single = F.col("low") == F.col("high")
    near = chosen.filter(single).select(
        *part, "n", "before", F.col("size").alias("copies"), F.col("low").alias("value")
    )
    several = chosen.filter(~single)
    if not small or not several.isEmpty():
        several = F.broadcast(several) if small else several
        near = near.unionByName(_inside(values, several, part, wanted))
    found = near.groupBy(*part).agg(
        F.max("n").alias("n"),
        *[F.max(F.when(_holds(rank, "copies"), value)).alias(f"v{i}") for i, rank in enumerate(wanted)],
    )
    quantiles = [
        F.col(f"v{2 * j}") + (F.col(f"v{2 * j + 1}") - F.col(f"v{2 * j}")) * (place - F.floor(place))
        for j, place in enumerate(places)
    ]
    name = F.array(*[F.lit(f) for f in features])[F.col("feature")].alias("feature")
    return found.select(*part[:-1], name, "n", F.array(*quantiles).alias("quantiles"))


def approximate_quantiles(
    df: DataFrame,
    probabilities,
    features=FEATURES,
    group: str | None = None,
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """The columns of ``exact_quantiles`` from one mergeable sketch: one pass, one shuffle.

    Each quantile is a value of the group whose rank is off by at most 1 / ``accuracy`` of it.
    """
    features, probabilities = present(df, features), [float(p) for p in probabilities]
    sketches, entries = [], []
    for i, f in enumerate(features):
        value = col(f)
        sketches += [
            F.count(value).alias(f"n{i}"),
            F.percentile_approx(value, probabilities, accuracy).alias(f"q{i}"),
        ]
        quantiles = F.col(f"q{i}").cast("array<double>").alias("quantiles")
        entries.append(F.struct(F.lit(f).alias("feature"), F.col(f"n{i}").alias("n"), quantiles))
    keys = [col(group).alias("group")] if group else []
    grouped = df.groupBy(*keys).agg(*sketches)
    return grouped.select(*["group" for _ in keys], F.inline(F.array(*entries))).filter("n > 0")
