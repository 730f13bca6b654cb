import numpy as np
import pytest
from pyspark.sql import functions as F

from centigram.operators import quantiles
from centigram.operators.quantiles import approximate_quantiles, exact_quantiles

PROBABILITIES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)


def check(df, features, group, steps, group_limit=None):
    rows = exact_quantiles(df, PROBABILITIES, features, group, steps, group_limit).collect()
    data = df.toPandas()
    keys = data[group].unique() if group else [None]
    assert len(rows) == len(keys) * len(features)
    for row in rows:
        part = data[data[group] == row["group"]] if group else data
        values = part[row["feature"]].dropna().to_numpy()
        assert row["n"] == len(values)
        np.testing.assert_allclose(row["quantiles"], np.quantile(values, PROBABILITIES), rtol=1e-12)


@pytest.fixture(scope="module")
def data(spark):
    """A hot group (2/3 of the rows), a hot value (1/2 of one column), a long tail and NULLs."""
    u = F.rand(3)
    return (
        spark.range(60_000)
        .select(
            F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 4).cast("int").alias("cluster"),
            F.exp(u * 20).alias("tail"),
            F.when(F.col("id") % 2 == 0, 7.0).otherwise(F.round(F.rand(5) * 100, 1)).alias("hot"),
            F.when(F.col("id") % 10 > 0, F.randn(6)).alias("gaps"),
        )
        .repartition(6)
        .cache()
    )


@pytest.mark.parametrize("steps", [1, 50, 1024, 10_000])
@pytest.mark.parametrize("group", [None, "cluster"])
def test_matches_numpy(data, group, steps):
    check(data, ("tail", "hot", "gaps"), group, steps)


def test_shuffle_join_variant(data, monkeypatch):
    monkeypatch.setattr(quantiles, "MOST_BUCKETS", 3)
    check(data, ("tail", "hot"), "cluster", 300)


def test_single_values_need_one_pass(data):
    found = exact_quantiles(data, PROBABILITIES, ("hot",), "cluster", steps=1 << 20)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan or "LogicalRDD" in plan
    assert "InMemoryRelation" not in plan
    check(data, ("hot",), "cluster", 1 << 20)


@pytest.mark.parametrize("low, width", [(1e6, 1e-3), (-1e6, 1e-3), (-1e-300, 1e-300), (-1e300, 2e300)])
def test_narrow_and_wide_ranges(spark, low, width):
    df = spark.range(5_000).select((F.lit(low) + F.rand(9) * F.lit(width)).alias("v")).cache()
    check(df, ("v",), None, 1024)


def test_infinities_and_nan_come_in_order(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(v,) for v in (nan, inf, 1.0, -inf, inf)], "v double")
    values = [exact_quantiles(df, (p,), ("v",)).first()["quantiles"][0] for p in (0.25, 1.0)]
    assert values[0] == 1.0 and np.isnan(values[1])


def test_more_groups_than_are_broadcast(spark):
    df = spark.range(60_000).select((F.col("id") % 12_000).alias("cluster"), F.col("id").cast("double").alias("v"))
    rows = exact_quantiles(df, (0.5,), ("v",), "cluster").collect()
    assert len(rows) == 12_000
    assert all(r["quantiles"] == [24_000.0 + r["group"]] for r in rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 11])
def test_small_groups(spark, n):
    df = spark.range(n).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    check(df, ("v",), None, 1024)


def test_all_equal_and_negative_zero(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (0.0,)], "v double")
    assert exact_quantiles(df, (0.5,), ("v",)).first()["quantiles"] == [0.0]


def test_group_without_values_has_no_row(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0)], "cluster int, v double")
    rows = exact_quantiles(df, (0.5,), ("v",), "cluster").collect()
    assert [(r["group"], r["quantiles"]) for r in rows] == [(2, [5.0])]


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (2, 5.0)], "cluster int, v double")
    rows = exact_quantiles(df, (0.5,), ("v",), "cluster").collect()
    assert {r["group"]: r["quantiles"] for r in rows} == {None: [2.0], 2: [5.0]}


def test_too_many_groups_fail_loudly(spark):
    df = spark.range(20).select(F.col("id").alias("cluster"), F.lit(1.0).alias("v"))
    with pytest.raises(ValueError, match="more than 5 groups"):
        exact_quantiles(df, (0.5,), ("v",), "cluster", group_limit=5)
    assert exact_quantiles(df, (0.5,), ("v",), "cluster", group_limit=20).count() == 20


@pytest.mark.parametrize("group", [None, "cluster"])
def test_approximate_ranks_are_near(data, group):
    accuracy = 200
    rows = approximate_quantiles(data, PROBABILITIES, ("tail", "hot", "gaps"), group, accuracy)
    frame = data.toPandas()
    for row in rows.collect():
        part = frame[frame[group] == row["group"]] if group else frame
        values = np.sort(part[row["feature"]].dropna().to_numpy())
        assert row["n"] == len(values)
        for p, q in zip(PROBABILITIES, row["quantiles"]):
            low, high = np.searchsorted(values, q, "left"), np.searchsorted(values, q, "right")
            slack = len(values) / accuracy + 1
            assert low - slack <= p * len(values) <= high + slack
