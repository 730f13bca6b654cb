import pytest
from pyspark.sql import functions as F

from centigram.operators import quality
from centigram.operators.nested import prepare_features


@pytest.fixture
def pairs(spark):
    def make(*rows):
        return spark.createDataFrame(rows, "a double, b double")

    return make


def test_any_positive(pairs):
    df = pairs((None, 1.0), (None, 0.0), (0.0, 0.0), (-1.0, 0.0))
    assert [tuple(r) for r in quality.any_positive(df, ("a", "b")).collect()] == [(None, 1.0)]


def test_rules_without_features_keep_all(pairs):
    df = pairs((None, 1.0), (0.0, 0.0))
    for keep in (quality.any_positive, quality.complete_cases, quality.zscore_filter):
        assert keep(df, ("none",)).count() == 2


def test_complete_cases(pairs):
    df = pairs((None, 1.0), (1.0, 1.0))
    assert quality.complete_cases(df, ("a", "b", "none")).count() == 1


def test_zscore_is_strict(pairs):
    # mean 0, sample deviation 1: the outer values sit exactly on the threshold
    df = pairs((-1.0, 0.0), (0.0, 0.0), (1.0, 0.0))
    assert [r["a"] for r in quality.zscore_filter(df, ("a",), 1.0).collect()] == [0.0]
    assert quality.zscore_filter(df, ("a",), 1.0 + 1e-9).count() == 3


def test_zscore_skips_constant_feature_but_drops_null(pairs):
    constant = pairs((5.0, 1.0), (5.0, 2.0), (5.0, 4.0))
    assert quality.zscore_filter(constant, ("a",)).count() == 3
    with_null = pairs((None, 1.0), (5.0, 2.0), (6.0, 4.0))
    assert quality.zscore_filter(with_null, ("a",)).count() == 2
    # an unusable feature does not judge its NULLs either
    only_null = pairs((None, 1.0), (5.0, 2.0))
    assert quality.zscore_filter(only_null, ("a",)).count() == 2


def test_zscore_rule_equals_filter(pairs):
    df = pairs(*[(float(i % 7), float(i * i)) for i in range(50)])
    kept = quality.zscore_filter(df, ("a", "b"), 1.2).count()
    report = quality.kept_report(df, {"z": quality.zscore_rule(df, ("a", "b"), 1.2)}).first()
    assert report["kept"] == kept and report["total"] == 50 and 0 < kept < 50


def test_zscore_plan_has_no_join(pairs):
    df = quality.zscore_filter(pairs((1.0, 2.0), (2.0, 3.0)), ("a", "b"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_null_profile_and_fill_rate(pairs):
    df = pairs((None, 1.0), (None, None), (1.0, 2.0), (None, 3.0))
    profile = {r["feature"]: r for r in quality.null_profile(df, ("a", "b", "none")).collect()}
    assert set(profile) == {"a", "b"}
    assert (profile["a"]["nulls"], profile["a"]["pct"]) == (3, 75.0)
    rates = {r["feature"]: r["keep"] for r in quality.fill_rate(df, ("a", "b")).collect()}
    assert rates == {"a": False, "b": True}
    assert quality.well_filled(df, ("a", "b")) == ["b"]


def test_reports_on_empty_input(pairs):
    df = pairs((1.0, 1.0)).limit(0)
    assert [(r["nulls"], r["pct"]) for r in quality.null_profile(df, ("a",)).collect()] == [(0, 0.0)]
    assert quality.fill_rate(df, ("a",)).first()["rate"] == 0.0
    report = quality.kept_report(df, {"all": F.lit(True)}).first()
    assert (report["total"], report["kept"], report["removed_pct"]) == (0, 0, 0.0)
    assert quality.feature_stats(df, ("a",)).first()["mean"] is None
    assert quality.row_count(df).first()["rows"] == 0


def test_observed_counts_ride_along(pairs):
    df, seen = quality.observed(pairs((None, 1.0), (2.0, 3.0)), "counts", ("a", "b"))
    df.collect()
    assert seen.get == {"rows": 2, "a_nulls": 1, "b_nulls": 0}


def test_nan_is_not_a_complete_case(pairs):
    df = pairs((float("nan"), 1.0), (2.0, 1.0))
    assert [r["a"] for r in quality.complete_cases(df, ("a", "b")).collect()] == [2.0]


@pytest.mark.parametrize("keep", [quality.any_positive, quality.complete_cases])
def test_filters_do_not_repeat_the_lookups(raw, keep):
    def lookups(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("array_position(")

    prepared = prepare_features(raw(("a", None, None)))
    assert lookups(keep(prepared)) == lookups(prepared) > 0
