"""Samples and limits."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from centigram.functions.columns import col
from centigram.functions.keys import hash_percent
from centigram.operators.selection import Cuts
from centigram.schemas import DEFAULT_SAMPLE_PERCENT, KEY

# Rows of a group that may meet in one task before slices of the tasks merge theirs.
GATHERED = 1_000_000


def order_columns(df: DataFrame, key: str):
    """The key, then every other column as a tie-breaker."""
    return [col(key), *[col(c) for c in df.columns if c != key]]


def _sliced(df: DataFrame, parts, order, n: int) -> DataFrame:
    """A superset of the first ``n`` rows of each part, at most ``n`` per part and slice of tasks."""
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = df.withColumn("_slice", F.spark_partition_id() % slices)
    place = F.row_number().over(Window.partitionBy(*parts, "_slice").orderBy(*order))
    return sliced.withColumn("_place", place).filter(F.col("_place") <= n).drop("_slice", "_place")


def _candidates(df: DataFrame, groups: list[str], key: str, order, n: int) -> DataFrame:
    """Rows up to the cut of their group; if many share the key where it falls, of slices their first."""
    cuts = Cuts(df, groups, key, n)
    rows = cuts.apply(df)
    if any(kept > GATHERED for kept in cuts.kept.values()):
        rows = _sliced(rows, [col(g) for g in groups], order, n)
    return rows


def head_by_key(df: DataFrame, n: int, key: str = KEY) -> DataFrame:
    """First ``n`` rows in key order; zero or a negative number keeps all rows.

    Two passes over the key find where these rows end, for any ``n``; only rows up to there are
    read whole, and only they are sorted.  Every column of ``df`` breaks ties.
    """
    if n <= 0:
        return df
    order = order_columns(df, key)
    return _candidates(df, [], key, order, n).orderBy(*order).limit(n)


def hash_sample(df: DataFrame, percent: int = DEFAULT_SAMPLE_PERCENT, key: str = KEY) -> DataFrame:
    """About ``percent`` % of the keys, always the same ones; a plain filter, no shuffle.

    A row without a key is in no sample below 100 %.
    """
    if percent >= 100:
        return df
    return df.filter(hash_percent(col(key)) < percent)


def random_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_then_head(df: DataFrame, percent: int, n: int, key: str = KEY) -> DataFrame:
    return head_by_key(hash_sample(df, percent, key), n, key)


def first_per_group(df: DataFrame, group: str, n: int, key: str = KEY) -> DataFrame:
    """First ``n`` rows of each group in key order, with their ``rank``.

    As in ``head_by_key``, passes over group and key find where each large group's first rows
    end; the others are small enough to be ranked as they are.
    """
    order = order_columns(df.drop(group), key)
    rows = _candidates(df, [group], key, order, n)
    rank = F.row_number().over(Window.partitionBy(col(group)).orderBy(*order))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= n)
