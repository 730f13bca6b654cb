import pytest

from centigram.functions.measurements import name_variants
from centigram.operators.nested import (
    cast_flat,
    extract_features,
    fill_nulls,
    prepare_features,
    rename_name_text,
)
from centigram.schemas import FEATURES


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_name_variants():
    assert name_variants("fat") == ["fat"]
    assert set(name_variants("energy-kcal")) == {"energy-kcal", "energy kcal", "energy_kcal"}
    assert set(name_variants("a_b-c")) == {"a_b-c", "a-b-c", "a_b c", "a_b_c", "a b-c"}


@pytest.mark.parametrize("spelling", ["energy-kcal", "energy kcal", "energy_kcal"])
def test_any_spelling(raw, spelling):
    row = one(extract_features(raw(("1", ["a"], [("fat", 1.0), (spelling, 2.0)]))))
    assert row["energy-kcal"] == 2.0 and row["fat"] == 1.0 and row["sugars"] is None


def test_array_order_decides_between_spellings(raw):
    values = [("energy_kcal", 7.0), ("energy-kcal", 8.0), ("energy kcal", 9.0)]
    assert one(extract_features(raw(("1", ["a"], values))))["energy-kcal"] == 7.0
    assert one(extract_features(raw(("1", ["a"], values[::-1]))))["energy-kcal"] == 9.0


def test_first_duplicate_wins_even_if_null(raw):
    row = one(extract_features(raw(("1", ["a"], [("fat", None), ("fat", 3.0)]))))
    assert row["fat"] is None


@pytest.mark.parametrize("values", [None, []])
def test_null_and_empty_arrays(raw, values):
    row = one(extract_features(raw(("1", values, values))))
    assert row["product_name"] is None
    assert all(row[f] is None for f in FEATURES)


def test_null_elements_are_skipped(spark):
    df = spark.sql(
        "SELECT '1' code, array(NULL, named_struct('name', 'fat', '100g', 2.5F)) nutriments"
    )
    assert one(extract_features(df))["fat"] == 2.5


def test_first_name(raw):
    assert one(extract_features(raw(("1", ["first", "second"], None))))["product_name"] == "first"


def test_string_name_is_kept(spark):
    df = spark.createDataFrame([("1", "plain", 1.0)], "code string, product_name string, fat double")
    row = one(extract_features(df))
    assert row.asDict() == {"code": "1", "product_name": "plain", "fat": 1.0}


def test_float_widens(raw):
    row = one(extract_features(raw(("1", ["a"], [("fat", 1.47)]))))
    assert row["fat"] == 1.4700000286102295


@pytest.mark.parametrize(
    "prefer, expected", [("flat", [5.0, None]), ("nested", [1.0, 2.0]), ("row", [5.0, 2.0])]
)
def test_preference(raw, prefer, expected):
    from pyspark.sql import functions as F

    df = raw(("1", None, [("fat", 1.0)]), ("2", None, [("fat", 2.0)]))
    df = df.withColumn("fat", F.when(F.col("code") == "1", "5.0").otherwise("abc"))
    rows = extract_features(df, ("fat",), prefer).orderBy("code").collect()
    assert [r["fat"] for r in rows] == expected


def test_unknown_preference(raw):
    with pytest.raises(ValueError):
        extract_features(raw(("1", None, None)), prefer="other")


def test_bad_numbers_become_null(spark):
    df = spark.createDataFrame([("abc",), ("1.5",)], "fat string")
    assert [r["fat"] for r in cast_flat(df, ("fat", "missing")).collect()] == [None, 1.5]


def test_fill_replaces_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.0,)], "fat double")
    assert [r["fat"] for r in fill_nulls(df).collect()] == [0.0, 0.0, 1.0]


def test_fill_without_features(spark):
    df = spark.createDataFrame([(1,)], "other int")
    assert fill_nulls(df).columns == ["other"]


def test_prepare_empty_input(raw, spark):
    empty = raw(("1", None, None)).limit(0)
    out = prepare_features(empty, remove_outliers=True)
    assert out.columns == ["code", "product_name", *FEATURES]
    assert out.count() == 0


def test_prepare_keeps_extra_columns(spark, raw):
    from pyspark.sql import functions as F

    df = raw(("1", ["a"], None)).withColumn("extra", F.lit(3))
    assert one(prepare_features(df, keep=("extra",)))["extra"] == 3


def test_outliers_are_judged_after_filling(raw):
    rows = [(str(i), ["p"], [("fat", 1.0)]) for i in range(30)]
    out = prepare_features(raw(*rows, ("x", ["p"], [("fat", 1000.0)]), ("n", ["p"], None)),
                           remove_outliers=True)
    assert {r["code"] for r in out.collect()} == {str(i) for i in range(30)} | {"n"}


def test_rename(spark):
    df = spark.createDataFrame([("a",)], "product_name_text string")
    assert rename_name_text(df).columns == ["product_name"]
    assert rename_name_text(rename_name_text(df)).columns == ["product_name"]


def test_only_needed_leaves_are_scanned(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "wide")
    spark.sql(
        """SELECT '1' code, array(named_struct('lang', 'main', 'text', 'a')) product_name,
           array(named_struct('name', 'fat', '100g', 1F, 'unit', 'g', 'value', 2F)) nutriments,
           'x' other"""
    ).write.parquet(path)
    prepared = prepare_features(spark.read.parquet(path))
    plan = prepared._jdf.queryExecution().toString()
    schema = plan.split("ReadSchema: ")[-1].splitlines()[0]
    assert "name:string" in schema or "..." in schema
    assert "unit" not in schema and "other" not in schema and "lang" not in schema
    assert prepared.agg(F.sum("fat")).first()[0] == 1.0


def test_features_with_too_few_values_go(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, 3.0)], "code string, fat double, sugars double")
    assert prepare_features(df, ("fat", "sugars"), min_fill=0.6).columns == ["code", "fat"]
    assert prepare_features(df, ("fat", "sugars"), min_fill=0.5).columns == ["code", "fat", "sugars"]
