import pytest
from pyspark.sql import functions as F

from centigram.operators import sampling, selection
from centigram.operators.nested import extract_features
from centigram.operators.selection import Cuts
from centigram.sources.products import read_products


def test_head_by_key(spark):
    df = spark.range(100).select(F.format_string("%03d", 99 - F.col("id")).alias("code"), "id")
    assert [r["code"] for r in sampling.head_by_key(df, 3).collect()] == ["000", "001", "002"]
    assert sampling.head_by_key(df, 0).count() == 100
    assert sampling.head_by_key(df, -1).count() == 100


def test_hash_sample_is_stable(spark):
    df = spark.range(10_000).select(F.col("id").cast("string").alias("code"))
    ten = {r["code"] for r in sampling.hash_sample(df, 10).collect()}
    again = {r["code"] for r in sampling.hash_sample(df.repartition(7), 10).collect()}
    twenty = {r["code"] for r in sampling.hash_sample(df, 20).collect()}
    assert ten == again and ten < twenty and 850 < len(ten) < 1150
    assert sampling.hash_sample(df, 100).count() == 10_000


def test_sample_then_head(spark):
    df = spark.range(1000).select(F.format_string("%04d", "id").alias("code"))
    picked = [r["code"] for r in sampling.sample_then_head(df, 50, 10).collect()]
    expected = sorted(r["code"] for r in sampling.hash_sample(df, 50).collect())[:10]
    assert picked == expected


def test_random_sample_repeats_with_a_seed(spark):
    df = spark.range(10_000)
    a, b = (sampling.random_sample(df, 0.1, 7).count() for _ in range(2))
    assert a == b and 800 < a < 1200


def test_first_per_group_with_a_hot_group(spark):
    # two thirds of the rows in one group
    df = spark.range(9000).select(
        F.format_string("%05d", "id").alias("code"),
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 5 + 1).alias("cluster"),
    )
    for n in (3, 2000):
        rows = sampling.first_per_group(df, "cluster", n).collect()
        expected = {}
        for r in df.orderBy("code").collect():
            expected.setdefault(r["cluster"], []).append(r["code"])
        for cluster, codes in expected.items():
            got = sorted((r["rank"], r["code"]) for r in rows if r["cluster"] == cluster)
            assert [c for _, c in got] == codes[:n]


def test_cuts_keep_equal_rows_and_missing_groups(spark):
    # half of all rows are copies of one row; a third has no group
    df = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, "same").otherwise(F.format_string("%05d", "id")).alias("code"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.nullif(F.col("id") % 3, F.lit(0))).alias("cluster"),
        F.lit(1.0).alias("a`b"),
    ).repartition(5)
    rows = sampling.first_per_group(df, "cluster", 1800).collect()
    expected = {}
    for r in df.orderBy("code").collect():
        expected.setdefault(r["cluster"], []).append(r["code"])
    assert set(expected) == {None, 1, 2}
    for cluster, codes in expected.items():
        got = sorted((r["rank"], r["code"]) for r in rows if r["cluster"] == cluster)
        assert got == list(enumerate(codes[:1800], 1))
    head = sampling.head_by_key(df, 3500)
    assert head.columns == df.columns
    assert sorted(r["code"] for r in head.collect()) == sorted(sum(expected.values(), []))[:3500]


@pytest.mark.parametrize("n", [5, 5000])
def test_first_rows_of_an_empty_table(spark, n):
    df = spark.createDataFrame([], "code string, cluster int")
    assert sampling.head_by_key(df, n).collect() == []
    assert sampling.first_per_group(df, "cluster", n).collect() == []


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [5, 1500])
def test_first_rows_copy_nothing_and_sort_only_what_lies_up_to_the_cut(spark, n, monkeypatch):
    df = spark.range(200_000).select(
        F.format_string("%07d", 199_999 - F.col("id")).alias("code"), (F.col("id") % 2).alias("cluster")
    )
    monkeypatch.setattr(type(df.write), "save", None)
    monkeypatch.setattr(type(df.write), "parquet", None)
    head, groups = sampling.head_by_key(df, n), sampling.first_per_group(df, "cluster", n)
    for rows in (head, groups):
        plan = executed(rows)
        assert "<=" in plan.split("Filter", 1)[1] and "_slice" not in plan
    assert [r["code"] for r in head.collect()] == [f"{k:07d}" for k in range(n)]
    assert groups.count() == 2 * n
    cuts = Cuts(df, ["cluster"], "code", n)
    assert all(n <= kept <= 8 * n + 400 for kept in cuts.kept.values()) and len(cuts.kept) == 2


def test_a_key_that_many_rows_share_is_merged_in_slices(spark, monkeypatch):
    monkeypatch.setattr(sampling, "GATHERED", 1000)
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 < 2, "b").otherwise(F.format_string("c%05d", "id")).alias("code"),
        F.format_string("%05d", "id").alias("tie"),
    )
    df = df.union(spark.createDataFrame([("a", "x"), (None, "y")], "code string, tie string"))
    head = sampling.head_by_key(df, 7)
    assert "_slice" in executed(head)
    assert [tuple(r) for r in head.collect()] == [
        (None, "y"), ("a", "x"), *(("b", f"{k:05d}") for k in (0, 1, 3, 4, 6)),
    ]


@pytest.mark.parametrize("accuracy", [10_000, 3])
def test_cuts_of_any_key_type_lose_no_row(spark, monkeypatch, accuracy):
    # a coarse sketch proposes poor cuts, which the counts mend
    monkeypatch.setattr(selection, "ACCURACY", accuracy)
    monkeypatch.setattr(selection, "ROOMY", 10)
    base = spark.range(3000).withColumn("x", F.pmod(F.xxhash64("id"), F.lit(1000)))
    keys = {
        "text": F.concat(F.lit("same beginning "), F.format_string("%04d", "x")),
        "short": F.when(F.col("x") > 20, F.col("x").cast("string")),
        "number": F.when(F.col("x") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("x") - 500.5),
        "whole": F.col("x") - 500,
        "day": F.date_add(F.lit("1969-12-01").cast("date"), F.col("x").cast("int")),
        "time": F.timestamp_micros(F.col("x") * 77 - 10_000),
        "exact": F.col("x").cast("decimal(20,3)") / 7,
        "list": F.array("x"),
    }
    df = base.select("id", (F.col("id") % 2 == 0).alias("g"), *[c.alias(n) for n, c in keys.items()])
    for key in keys:
        some = df.select(key, "id", "g")
        for n in (1, 40, 2999):
            want = [r["id"] for r in some.orderBy(key, "id").limit(n).collect()]
            assert [r["id"] for r in sampling.head_by_key(some, n, key).collect()] == want
        ranked = sampling.first_per_group(some, "g", 40, key).collect()
        for g in (True, False):
            want = [r["id"] for r in some.filter(F.col("g") == g).orderBy(key, "id").limit(40).collect()]
            assert [r["id"] for r in sorted(ranked, key=lambda r: r["rank"]) if r["g"] == g] == want


def test_head_reads_only_extracted_fields(spark, raw, tmp_path):
    raw(("1", ["a"], [("fat", 1.0)])).write.parquet(str(tmp_path / "p"))
    products = read_products(spark, str(tmp_path / "p"))
    scan = executed(sampling.head_by_key(extract_features(products), 10)).split("ReadSchema:")[1]
    assert "text:string" in scan and "lang" not in scan
