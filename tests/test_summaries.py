import numpy as np
import pytest
from pyspark.sql import functions as F

from centigram.functions.json_rows import centers_from_json, centers_to_json
from centigram.operators import summaries

XY = ("x", "y")


@pytest.fixture
def rows(numbers):
    data = [(f"{i:03d}", 0 if i % 3 < 2 else 1, float(i % 17), float(i)) for i in range(90)]
    data.append(("out", 1, 500.0, 1.0))
    return numbers(data)


def test_sizes_and_shares_with_an_empty_cluster(rows):
    sizes = summaries.cluster_sizes(rows, k=3)
    assert {r["cluster"]: r["size"] for r in sizes.collect()} == {0: 60, 1: 31, 2: 0}
    assert {r["cluster"] for r in summaries.cluster_sizes(rows).collect()} == {0, 1}
    shares = {r["cluster"]: r["share"] for r in summaries.cluster_share(sizes).collect()}
    assert shares == {0: 65.93, 1: 34.07, 2: 0.0}
    assert summaries.cluster_distinct(rows).first()["clusters"] == 2


def test_shares_of_nothing(rows):
    empty = summaries.cluster_share(summaries.cluster_sizes(rows.limit(0), k=2))
    assert [r["share"] for r in empty.collect()] == [0.0, 0.0]


def test_published_shares(spark):
    # Sizes and shares of a published run.
    sizes = {0: 7801, 1: 131, 2: 226, 3: 17, 4: 1825}
    shares = {0: 78.01, 1: 1.31, 2: 2.26, 3: 0.17, 4: 18.25}
    df = spark.createDataFrame(list(sizes.items()), "cluster int, size bigint")
    assert {r["cluster"]: r["share"] for r in summaries.cluster_share(df).collect()} == shares


def test_samples_drop_vectors(rows):
    df = rows.withColumn("features", F.lit(1)).withColumn("scaled_features", F.lit(2))
    samples = summaries.cluster_samples(df, 2)
    assert samples.columns == ["code", "cluster", "x", "y", "rank"]
    assert {(r["cluster"], r["code"]) for r in samples.collect()} == {
        (0, "000"), (0, "001"), (1, "002"), (1, "005")
    }


def test_centers_shapes(rows):
    means = summaries.cluster_means(rows, XY)
    long = summaries.centers_long(means, XY)
    assert long.columns == ["cluster", "feature", "value"] and long.count() == 4
    wide = {r["cluster"]: r for r in summaries.centers_wide(long, XY).collect()}
    exact = {r["cluster"]: r for r in means.collect()}
    assert all(wide[c][f] == round(exact[c][f], 2) for c in (0, 1) for f in XY)
    back = centers_from_json(centers_to_json(long, XY))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect()))


@pytest.mark.parametrize("group_limit", [10, None])
def test_box_plot_by_brute_force(rows, group_limit):
    out = summaries.distribution_by_cluster(rows, XY, group_limit=group_limit).collect()
    data = rows.toPandas()
    assert len(out) == 4
    for row in out:
        v = data[data["cluster"] == row["cluster"]][row["feature"]].to_numpy()
        q1, median, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        reach = 1.5 * (q3 - q1)
        inside = v[(v >= q1 - reach) & (v <= q3 + reach)]
        expected = [len(v), v.min(), q1, median, q3, v.max(), inside.min(), inside.max()]
        names = ["n", "min", "q1", "median", "q3", "max", "whisker_low", "whisker_high"]
        np.testing.assert_allclose([row[n] for n in names], expected)
        assert row["outliers"] == len(v) - len(inside)


def test_whisker_stops_at_the_box(numbers):
    # the upper quartile is interpolated towards an outlier: no value lies between
    df = numbers([(str(i), 0, v, 0.0) for i, v in enumerate([1.0, 1.0, 1.0, 100.0])])
    row = summaries.distribution_by_cluster(df, ("x",)).first()
    assert (row["q3"], row["whisker_high"], row["outliers"]) == (25.75, 25.75, 1)


def test_density_counts_every_row(rows):
    cells = summaries.density_2d_by_cluster(rows, "x", "y", bins=4).collect()
    assert sum(r["count"] for r in cells) == 91
    assert max(r["bx"] for r in cells) == 3 and min(r["by"] for r in cells) == 0


def test_density_of_a_constant(numbers):
    cells = summaries.density_2d_by_cluster(numbers([("a", 0, 1.0, 1.0)]), "x", "y").collect()
    assert [(r["bx"], r["by"], r["count"]) for r in cells] == [(0, 0, 1)]


def test_detail_fills_gaps(rows):
    shares = summaries.cluster_share(summaries.cluster_sizes(rows, k=3))
    centers = summaries.centers_long(summaries.cluster_means(rows, XY), XY)
    detail = summaries.cluster_detail(shares, centers, summaries.cluster_samples(rows, 2), XY)
    empty = detail.filter("cluster = 2").collect()
    assert len(empty) == 1 and empty[0]["sample"] == 0 and empty[0]["size"] == 0
    assert (empty[0]["code"], empty[0]["product_name"], empty[0]["x"]) == ("N/A", "N/A", "N/A")
    assert detail.count() == 5


def test_run_metrics(spark, rows):
    silhouette = spark.createDataFrame([(0.5,)], "silhouette double")
    row = summaries.run_metrics(summaries.cluster_sizes(rows, k=3), silhouette).first()
    assert row["success"] and row["cluster_count"] == 3 and row["silhouette_score"] == 0.5
    assert row["cluster_sizes"] == {"0": 60, "1": 31, "2": 0}


def test_any_number_of_clusters(spark):
    sizes = spark.range(10_050).select(F.col("id").cast("int").alias("cluster"), F.lit(1).alias("size"))
    silhouette = spark.createDataFrame([(0.5,)], "silhouette double")
    assert summaries.cluster_share(sizes).agg(F.sum("size")).first()[0] == 10_050
    assert summaries.run_metrics(sizes, silhouette).first()["cluster_count"] == 10_050
    assert summaries.cluster_share(sizes.limit(0)).count() == 0
