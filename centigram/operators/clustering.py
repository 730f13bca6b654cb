"""K-means: fit, persist, score, and assignment to stored centres."""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import (
    MaxAbsScalerModel,
    MinMaxScalerModel,
    RobustScalerModel,
    StandardScalerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centigram.functions.columns import col
from centigram.operators.points import cluster_rows, matrix, row_blocks
from centigram.operators.scaling import assembler_stage, scaler_stage
from centigram.schemas import (
    CENTERS,
    CLUSTER,
    DEFAULT_K,
    DEFAULT_MAX_ITER,
    DEFAULT_METHOD,
    DEFAULT_SEED,
    FEATURES,
)


SCALER_MODELS = {
    StandardScalerModel: "standard",
    MinMaxScalerModel: "minmax",
    MaxAbsScalerModel: "maxabs",
    RobustScalerModel: "robust",
}


# Rows of the table behind the points of one k-means task; about 100 MB if all are distinct.
TASK_ROWS = 500_000


@dataclass(frozen=True)
class Signature:
    """What a fitted model reads and in which order, how it scales, and how many centres it has."""

    features: tuple[str, ...]
    method: str
    size: int

    def accepts(self, features=None, method: str | None = None) -> None:
        """Raise unless a caller's features (in any order) and method are the model's."""
        if features is not None and sorted(features) != sorted(self.features):
            raise ValueError(
                f"the model was fitted on {list(self.features)}, not on {list(features)}"
            )
        if method is not None and method != self.method:
            raise ValueError(f"the model scales by {self.method!r}, not by {method!r}")


def signature(model: PipelineModel) -> Signature:
    """Read from the model's own stages, so a saved model carries it wherever it is loaded."""
    stages = model.stages
    if len(stages) != 3 or not isinstance(stages[0], VectorAssembler):
        raise ValueError("not a model of assembler, scaler and k-means")
    if type(stages[1]) not in SCALER_MODELS or not isinstance(stages[2], KMeansModel):
        raise ValueError("not a model of assembler, scaler and k-means")
    features, centers = tuple(stages[0].getInputCols()), stages[2].clusterCenters()
    if any(len(center) != len(features) for center in centers):
        raise ValueError(f"the model's centres do not have its {len(features)} features")
    return Signature(features, SCALER_MODELS[type(stages[1])], len(centers))


def weighted_points(df: DataFrame, features=FEATURES, partitions: int | None = None) -> DataFrame:
    """Distinct measurement vectors with ``weight`` = number of rows, in a fixed layout.

    Equal rows are merged before the shuffle, so a vector shared by a third of the table
    is one point.  The layout depends only on the points and ``partitions``: k-means draws
    its first centres by partition, so a fixed layout makes a seed repeatable.  By default they
    are the session's shuffle partitions, or more, so that a task's points do not grow with the table.
    """
    if not partitions:
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        partitions = max(least, -(-df.count() // TASK_ROWS))
    columns = [col(f) for f in features]
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    # Spread by a derived key: repartitioning by the grouping columns themselves would be
    # folded into the aggregation's shuffle, whose partitions adaptive execution merges.
    return counted.repartition(partitions, F.xxhash64(*columns)).sortWithinPartitions(*columns)


def fit(
    df: DataFrame,
    features=FEATURES,
    k: int = DEFAULT_K,
    method: str = DEFAULT_METHOD,
    max_iter: int = DEFAULT_MAX_ITER,
    seed: int = DEFAULT_SEED,
    partitions: int | None = None,
) -> PipelineModel:
    """Assembler, scaler and k-means fitted together, so new rows land in the same space.

    The scaler sees every row.  K-means iterates over the weighted distinct points, which the
    estimator keeps in executor storage; a lost one is computed again from the shuffle or
    ``df``, so pass a stored table.  ``partitions`` bounds the points of one task.
    """
    assembler = assembler_stage(features)
    scaler = scaler_stage(method).fit(assembler.transform(df))
    points = weighted_points(df, features, partitions)
    kmeans = KMeans(
        k=k,
        maxIter=max_iter,
        seed=seed,
        featuresCol="scaled_features",
        predictionCol=CLUSTER,
        weightCol="weight",
        # The block solver fails when the data has fewer distinct points than k.
        solver="row",
    )
    model = kmeans.fit(scaler.transform(assembler.transform(points)))
    return PipelineModel(stages=[assembler, scaler, model])


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``features``, ``scaled_features`` and the integer ``cluster``.

    The model takes its columns by name; which others there are and in which order is no matter.
    """
    absent = [f for f in signature(model).features if f not in df.columns]
    if absent:
        raise ValueError(f"the rows have no column for the model's features {absent}")
    return model.transform(df).withColumn(CLUSTER, col(CLUSTER).cast("int"))


def model_centers(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The model's centres as (cluster, feature, value), in scaled units, clusters from 0."""
    features = signature(model).features
    rows = [
        (i, f, float(v))
        for i, center in enumerate(model.stages[-1].clusterCenters())
        for f, v in zip(features, center, strict=True)
    ]
    return spark.createDataFrame(rows, CENTERS)


def model_size(model: PipelineModel) -> int:
    """Number of centres; below ``k`` if the data had fewer distinct points."""
    return len(model.stages[-1].clusterCenters())


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def model_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path.rstrip("/") + "/metadata")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def load_or_fit(
    spark: SparkSession, path: str, train: Callable[[], PipelineModel] | None = None
) -> PipelineModel | None:
    """The saved model; if there is none, train and save one (None without ``train``).

    A model that is there but cannot be read is an error, not a reason to replace it.
    """
    if model_exists(spark, path):
        return PipelineModel.load(path)
    if train is None:
        return None
    model = train()
    save_model(model, path)
    return model


def assign_to_centers(
    df: DataFrame, centers: DataFrame, k: int = DEFAULT_K, features=FEATURES
) -> DataFrame:
    """Add ``cluster`` (nearest of the ``k`` long centres, ties to the lowest id) and ``distance``.

    Both are NULL for a row that lacks a feature; a centre that lacks one is nobody's.  The
    centres are read when the function is called and reach the rows with it, so the table is
    neither joined nor shuffled and the plan does not grow with ``k``.
    """
    wide = centers.groupBy(CLUSTER).agg(
        *[
            F.max(F.when(F.col("feature") == f, F.col("value"))).alias(f"m{i}")
            for i, f in enumerate(features)
        ]
    )
    whole = [r for r in cluster_rows(wide, CLUSTER, k) if None not in r]
    ids = np.array([r[CLUSTER] for r in whole], np.int32)
    places = np.array([r[1:] for r in whole], np.float64).reshape(len(whole), len(features))

    def block(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        squared = np.zeros((len(points), len(ids)))
        for i in range(points.shape[1]):
            difference = points[:, i, None] - places[:, i]
            squared += difference * difference
        # NaN is farther than any number; the lowest id wins a tie.
        best = np.argmin(np.where(np.isnan(squared), np.inf, squared), axis=1)
        return ids[best], np.sqrt(squared[np.arange(len(points)), best])

    def nearest(*columns: pa.Array) -> pa.Array:
        points, missing = matrix(columns)
        label, distance = np.zeros(len(points), np.int32), np.zeros(len(points))
        if len(ids):
            for s in row_blocks(len(points), len(ids)):
                label[s], distance[s] = block(points[s])
        else:
            missing[:] = True
        parts = [pa.array(label, mask=missing), pa.array(distance, mask=missing)]
        return pa.StructArray.from_arrays(parts, ["id", "distance"])

    rows = df.drop(CLUSTER)
    found = F.arrow_udf(nearest, "id int, distance double")
    return rows.withColumn("_nearest", found(*[col(f).cast("double") for f in features])).select(
        *[col(c) for c in rows.columns],
        F.col("_nearest.id").alias(CLUSTER),
        F.col("_nearest.distance").alias("distance"),
    )
