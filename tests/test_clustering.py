import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import functions as F

from catalogue.queries import by_first_code
from centigram.operators import clustering, evaluation, summaries
from centigram.operators.points import BLOCK, row_blocks
from centigram.operators.scaling import vector_columns
from centigram.plans import jobs
from centigram.schemas import CENTERS

XY = ("x", "y")


@pytest.fixture(scope="module")
def blobs(spark):
    """Three clear blobs; a third of all rows are copies of one point."""
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(c, 0.3, (100, 2)) for c in ((0, 0), (8, 0), (0, 8))])
    rows = [(f"{i:04d}", float(a), float(b)) for i, (a, b) in enumerate(points)]
    rows += [(f"c{i:04d}", 0.25, 0.25) for i in range(150)]
    return spark.createDataFrame(rows, "code string, x double, y double").repartition(5).cache()


def test_weighted_points_merge_copies(blobs):
    points = clustering.weighted_points(blobs, XY, 3)
    rows = points.collect()
    assert len(rows) == 301 and sum(r["weight"] for r in rows) == 450
    assert max(r["weight"] for r in rows) == 150
    assert points.rdd.getNumPartitions() == 3


def test_fit_finds_the_blobs_and_repeats(blobs):
    first = clustering.fit(blobs, XY, k=3, partitions=4)
    second = clustering.fit(blobs.repartition(9, "y"), XY, k=3, partitions=4)
    a, b = (np.array(m.stages[-1].clusterCenters()) for m in (first, second))
    np.testing.assert_allclose(a, b, atol=1e-9)
    scored = clustering.score(first, blobs)
    sizes = {r["cluster"]: r["size"] for r in summaries.cluster_sizes(scored, 3).collect()}
    assert sorted(sizes.values()) == [100, 100, 250]
    assert dict(scored.dtypes)["cluster"] == "int"


def test_size_weighted_centers_average_to_zero(spark, blobs):
    model = clustering.fit(blobs, XY, k=3)
    scored = clustering.score(model, blobs)
    sizes = summaries.cluster_sizes(scored, 3)
    centers = clustering.model_centers(spark, model)
    weighted = centers.join(sizes, "cluster").groupBy("feature").agg(
        (F.sum(F.col("value") * F.col("size")) / F.sum("size")).alias("m")
    )
    assert all(abs(r["m"]) < 1e-9 for r in weighted.collect())


def test_every_row_is_at_its_nearest_center(spark, blobs):
    model = clustering.fit(blobs, XY, k=3)
    scored = vector_columns(clustering.score(model, blobs), XY)
    centers = clustering.model_centers(spark, model)
    renamed = centers.withColumn("feature", F.concat(F.lit("scaled_"), "feature"))
    again = clustering.assign_to_centers(
        scored.withColumn("fitted", F.col("cluster")), renamed, 3, ("scaled_x", "scaled_y")
    )
    assert again.filter("fitted <> cluster").count() == 0


@pytest.mark.parametrize("method", ["standard", "minmax", "maxabs", "robust"])
def test_every_scaling_method_fits(blobs, method):
    assert clustering.model_size(clustering.fit(blobs, XY, k=3, method=method)) == 3


def test_fewer_points_than_clusters(spark):
    rows = [(str(i), float(i % 3), 1.0) for i in range(30)]
    df = spark.createDataFrame(rows, "code string, x double, y double")
    model = clustering.fit(df, XY, k=5)
    assert clustering.model_size(model) == 3


def test_saved_model_scores_the_same_and_keeps_its_scaler(spark, blobs, tmp_path):
    path = str(tmp_path / "model")
    assert clustering.load_or_fit(spark, path) is None
    calls = []

    def train():
        calls.append(1)
        return clustering.fit(blobs, XY, k=3)

    fitted = clustering.load_or_fit(spark, path, train)
    loaded = clustering.load_or_fit(spark, path, train)
    assert len(calls) == 1
    # a batch with another spread must still land in the training space
    batch = spark.createDataFrame([("a", 8.0, 0.0), ("b", 0.0, 8.0)], blobs.schema)
    one, two = (
        {r["code"]: (r["cluster"], tuple(r["scaled_features"])) for r in
         clustering.score(m, batch).collect()}
        for m in (fitted, loaded)
    )
    assert one == two and one["a"][0] != one["b"][0]


def test_unreadable_model_is_an_error(spark, tmp_path):
    path = tmp_path / "model" / "metadata"
    path.mkdir(parents=True)
    (path / "part-00000").write_text("not a model")
    with pytest.raises(Exception):
        clustering.load_or_fit(spark, str(tmp_path / "model"), lambda: pytest.fail("retrained"))


def test_assignment_ties_go_to_the_lowest_id(spark, numbers):
    centers = spark.createDataFrame(
        [(c, f, v) for c, v in ((0, 2.0), (1, 0.0), (2, 2.0)) for f in XY], CENTERS
    )
    df = numbers([("a", 9, 1.0, 1.0), ("b", 9, 2.0, 2.0), ("c", 9, 0.1, 0.0)])
    rows = clustering.assign_to_centers(df, centers, 3, XY).collect()
    assert {r["code"]: r["cluster"] for r in rows} == {"a": 0, "b": 0, "c": 1}
    assert {r["code"]: round(r["distance"], 6) for r in rows}["a"] == round(2**0.5, 6)


def test_assignment_neither_joins_nor_shuffles_the_rows(spark, numbers):
    centers = spark.createDataFrame([(0, "x", 1.0), (0, "y", 1.0)], CENTERS)
    out = clustering.assign_to_centers(numbers([("a", 0, 1.0, 1.0)]), centers, 1, XY)
    plan = out._jdf.queryExecution().executedPlan().toString()
    main = "\n".join(l for l in plan.splitlines() if "Subquery" not in l and ":" not in l[:12])
    assert "Join" not in plan and "Exchange hashpartitioning(code" not in main


def test_center_ids_outside_the_range_fail(spark, numbers):
    centers = spark.createDataFrame([(4, "x", 1.0), (4, "y", 1.0)], CENTERS)
    with pytest.raises(Exception, match="cluster id outside"):
        clustering.assign_to_centers(numbers([("a", 0, 1.0, 1.0)]), centers, 3, XY).collect()


def test_rows_without_a_value_belong_nowhere(spark, numbers):
    rows = [("a", 0, 1.0, 1.0), ("b", 0, None, 1.0), ("c", 1, 5.0, 5.0), ("d", 1, 6.0, 5.0), ("e", 0, 1.5, 1.0)]
    df = numbers(rows)
    centers = spark.createDataFrame([(c, f, v) for c, v in ((0, 1.0), (2, 5.0)) for f in XY], CENTERS)
    lame = centers.unionByName(spark.createDataFrame([(1, "x", 1.0)], CENTERS))
    near = {r["code"]: (r["cluster"], r["distance"]) for r in clustering.assign_to_centers(df, lame, 3, XY).collect()}
    assert near == {"a": (0, 0.0), "b": (None, None), "c": (2, 0.0), "d": (2, 1.0), "e": (0, 0.5)}
    nowhere = clustering.assign_to_centers(df, centers.limit(0), 3, XY).collect()
    assert {(r["cluster"], r["distance"]) for r in nowhere} == {(None, None)}
    scores = {r["code"]: r["silhouette"] for r in evaluation.silhouette_rows(df, 2, XY).collect()}
    assert scores.pop("b") is None and all(-1 <= s <= 1 for s in scores.values())
    assert evaluation.silhouette_rows(df.limit(0), 2, XY).count() == 0
    with pytest.raises(ValueError, match="cluster id outside"):
        evaluation.silhouette_rows(numbers([("a", None, 1.0, 1.0)]), 2, XY)


@pytest.mark.parametrize("clusters", [1, 7, BLOCK, 3 * BLOCK])
def test_blocks_cover_all_rows_and_stay_small(clusters):
    rows = 1_000 if clusters > 7 else 2 * BLOCK
    places = [range(rows)[s] for s in row_blocks(rows, clusters)]
    assert [i for part in places for i in part] == list(range(rows))
    assert max(len(part) for part in places) <= max(1, BLOCK // clusters)


def test_silhouette_equals_the_evaluator(spark, blobs):
    model = clustering.fit(blobs, XY, k=3)
    scored = vector_columns(clustering.score(model, blobs), XY)
    by_cluster = evaluation.silhouette_by_cluster(scored, 3, ("scaled_x", "scaled_y"))
    ours = evaluation.silhouette_overall(by_cluster).first()["silhouette"]
    theirs = ClusteringEvaluator(
        predictionCol="cluster", featuresCol="scaled_features"
    ).evaluate(scored.drop("features"))
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_silhouette_by_brute_force(numbers):
    rng = np.random.default_rng(2)
    points = rng.normal(0, 1, (40, 2))
    labels = [0] * 1 + [1] * 19 + [2] * 20
    rows = [(f"{i:02d}", c, float(p[0]), float(p[1])) for i, (c, p) in enumerate(zip(labels, points))]
    # id 3 is an empty cluster
    out = evaluation.silhouette_rows(numbers(rows), 4, XY).orderBy("code").collect()
    labels = np.array(labels)
    for i, row in enumerate(out):
        d = ((points - points[i]) ** 2).sum(axis=1)
        own = labels == labels[i]
        if own.sum() == 1:
            assert row["silhouette"] == 0.0
            continue
        a = d[own].sum() / (own.sum() - 1)
        b = min(d[labels == c].mean() for c in {0, 1, 2} - {labels[i]})
        assert row["silhouette"] == pytest.approx((b - a) / max(a, b), abs=1e-9)


@pytest.mark.parametrize("k", [1, 3])
def test_one_cluster_has_no_silhouette(numbers, k):
    df = numbers([("a", 0, 1.0, 1.0), ("b", 0, 2.0, 5.0)])
    by_cluster = evaluation.silhouette_by_cluster(df, k, XY)
    assert by_cluster.first()["silhouette"] is None
    assert evaluation.silhouette_overall(by_cluster).first()["silhouette"] is None


def test_report_tables_run_nothing_before_they_are_asked_for(spark, blobs):
    report = jobs.describe(clustering.fit(blobs, XY, k=3), blobs)
    assert not {"silhouettes", "metrics", "distribution"} & set(vars(report))
    assert report.distribution.count() == 6 and report.distribution is report.distribution
    report.close()


def test_plans_do_not_grow_with_the_clusters(spark, numbers):
    df = numbers([("a", 0, 1.0, 1.0), ("b", 1, 2.0, 2.0)])
    centers = spark.createDataFrame([(0, "x", 1.0), (0, "y", 1.0)], CENTERS)

    def size(df):
        return len(df._jdf.queryExecution().optimizedPlan().toString().splitlines())

    for make in (
        lambda k: evaluation.silhouette_by_cluster(df, k, XY),
        lambda k: clustering.assign_to_centers(df, centers, k, XY),
    ):
        assert size(make(5)) == size(make(300))


def test_points_of_a_task_do_not_grow_with_the_table(blobs, monkeypatch):
    monkeypatch.setattr(clustering, "TASK_ROWS", 100)
    points = clustering.weighted_points(blobs, XY)
    assert points.rdd.getNumPartitions() == 5
    assert points.count() == 301
    assert clustering.weighted_points(blobs, XY, 3).rdd.getNumPartitions() == 3


def test_renumbering_neither_joins_nor_shuffles_the_rows(spark):
    scored = spark.createDataFrame([("c", 0), ("b", 2), ("d", 0), ("a", 2)], "code string, cluster int")
    rows = spark.createDataFrame([(0, "x"), (2, "y"), (2, "z"), (1, "not scored")], "cluster int, v string")
    found = by_first_code(rows, scored)
    assert found.columns == ["v", "cluster"]
    assert sorted(tuple(r) for r in found.collect()) == [("x", 1), ("y", 0), ("z", 0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning(cluster" not in plan
