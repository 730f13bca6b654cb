"""User-level jobs: sources, operators and sinks put together.

The caller owns the session; a job never stops it.
"""

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from centigram.functions.json_rows import centers_to_json, rows_to_json
from centigram.operators import clustering, evaluation, summaries
from centigram.operators.nested import extract_features, prepare_features
from centigram.operators.quality import any_positive, observed
from centigram.operators.sampling import hash_sample, head_by_key
from centigram.operators.scaling import vector_columns
from centigram.operators.text import word_count
from centigram.schemas import (
    CLUSTER,
    DEFAULT_BATCH_ROWS,
    DEFAULT_K,
    DEFAULT_MAX_ITER,
    DEFAULT_METHOD,
    DEFAULT_SAMPLES_PER_CLUSTER,
    DEFAULT_SEED,
    FEATURES,
    KEY,
    NAME,
)
from centigram.sinks.scratch import remove, scratch_path, stored
from centigram.sinks.tables import (
    append_products,
    product_rows,
    write_centers,
    write_json_rows,
    write_results,
    write_word_counts,
)
from centigram.sources.products import read_lines, read_products


@dataclass
class Report:
    """Everything one clustering run produces, as DataFrames over its scored table."""

    model: PipelineModel
    scored: DataFrame
    centers: DataFrame
    center_table: DataFrame
    density: DataFrame | None
    features: tuple = FEATURES
    samples_per_cluster: int = DEFAULT_SAMPLES_PER_CLUSTER
    scratch: list[str] = field(default_factory=list)

    # These read the scored table when they are made, so they are made when first asked for.
    # Sizes, samples and silhouettes have a few rows per cluster and serve other tables too, so
    # they are stored: each of them then reads the scored table for one use only.

    def _kept(self, name: str, rows: DataFrame) -> DataFrame:
        path = scratch_path(self.scored.sparkSession, name)
        self.scratch.append(path)
        return stored(rows, path)

    @cached_property
    def sizes(self) -> DataFrame:
        k = clustering.model_size(self.model)
        return self._kept("sizes", summaries.cluster_sizes(self.scored, k))

    @cached_property
    def shares(self) -> DataFrame:
        return summaries.cluster_share(self.sizes)

    @cached_property
    def samples(self) -> DataFrame:
        names = [c for c in (KEY, NAME) if c in self.scored.columns]
        rows = self.scored.select(*names, *self.features, CLUSTER)
        return self._kept("samples", summaries.cluster_samples(rows, self.samples_per_cluster))

    @cached_property
    def detail(self) -> DataFrame:
        return summaries.cluster_detail(self.shares, self.centers, self.samples, self.features)

    @cached_property
    def silhouettes(self) -> DataFrame:
        scaled = [f"scaled_{f}" for f in self.features]
        k = clustering.model_size(self.model)
        return self._kept("silhouettes", evaluation.silhouette_by_cluster(self.scored, k, scaled))

    @cached_property
    def metrics(self) -> DataFrame:
        overall = evaluation.silhouette_overall(self.silhouettes)
        return summaries.run_metrics(self.sizes, overall)

    @cached_property
    def distribution(self) -> DataFrame:
        return summaries.distribution_by_cluster(self.scored, self.features)

    def close(self) -> None:
        """Delete the scratch tables behind the report; its DataFrames end with them."""
        for path in self.scratch:
            remove(self.scored.sparkSession, path)


def describe(
    model: PipelineModel,
    prepared: DataFrame,
    samples_per_cluster: int = DEFAULT_SAMPLES_PER_CLUSTER,
    scored_path: str | None = None,
) -> Report:
    """Score ``prepared`` once into a stored table and derive every summary from that table.

    Features and their order are the model's.  Without ``scored_path`` the tables are scratch, which ``close`` on the report deletes.
    """
    spark = prepared.sparkSession
    signed = clustering.signature(model)
    features = signed.features
    path = scored_path or scratch_path(spark, "scored")
    scaled = [f"scaled_{f}" for f in features]
    names = [c for c in (KEY, NAME) if c in prepared.columns]
    columns = vector_columns(clustering.score(model, prepared), features)
    scored = stored(columns.select(*names, *features, *scaled, CLUSTER), path)

    centers = clustering.model_centers(spark, model)
    return Report(
        model=model,
        scored=scored,
        centers=centers,
        center_table=summaries.centers_wide(centers, features),
        density=summaries.density_2d_by_cluster(scored, *features[:2])
        if len(features) > 1
        else None,
        features=tuple(features),
        samples_per_cluster=samples_per_cluster,
        scratch=[] if scored_path else [path],
    )


REPORT_TABLES = (
    "centers",
    "sizes",
    "shares",
    "samples",
    "silhouettes",
    "detail",
    "center_table",
    "distribution",
    "density",
)


def save_report(report: Report, path: str) -> None:
    """The model, the run metrics as JSON, and every table of the report as Parquet.

    Each under its own name in ``path``; what an earlier report left there is replaced.
    """
    clustering.save_model(report.model, f"{path}/model")
    report.metrics.write.mode("overwrite").json(f"{path}/metrics")
    for name in REPORT_TABLES:
        table = getattr(report, name)
        if table is None:
            remove(report.scored.sparkSession, f"{path}/{name}")
        else:
            table.write.mode("overwrite").parquet(f"{path}/{name}")


def export_json(report: Report, path: str) -> None:
    """Scored rows as JSON lines under ``path``/rows, the centre matrix under ``path``/centers."""
    write_json_rows(report.scored, f"{path}/rows")
    matrix = centers_to_json(report.centers, report.features)
    matrix.write.mode("overwrite").text(f"{path}/centers")


def chosen(products: DataFrame, features, percent: int, limit: int) -> DataFrame:
    """A hash sample of the products, of it the first ``limit`` in key order; all by default.

    With a limit the features are extracted first, so that choosing does not read and sort
    nested fields.
    """
    sampled = hash_sample(products, percent)
    if limit <= 0:
        return sampled
    return head_by_key(extract_features(sampled, features), limit)


def train_report(
    products: DataFrame,
    features=FEATURES,
    k: int = DEFAULT_K,
    method: str = DEFAULT_METHOD,
    max_iter: int = DEFAULT_MAX_ITER,
    seed: int = DEFAULT_SEED,
    remove_outliers: bool = False,
    samples_per_cluster: int = DEFAULT_SAMPLES_PER_CLUSTER,
    partitions: int | None = None,
    scored_path: str | None = None,
    min_fill: float | None = None,
    percent: int = 100,
    limit: int = 0,
) -> Report:
    """Prepare raw products, fit, score and summarise.

    With ``min_fill`` the run uses only the features that are filled in that share of the rows;
    the model knows which.  ``percent`` and ``limit`` choose products as in ``etl``.
    """
    spark = products.sparkSession
    path = scratch_path(spark, "prepared")
    try:
        some = chosen(products, features, percent, limit)
        rows = prepare_features(some, features, remove_outliers=remove_outliers, min_fill=min_fill)
        features = tuple(f for f in features if min_fill is None or f in rows.columns)
        prepared = stored(rows, path)
        model = clustering.fit(prepared, features, k, method, max_iter, seed, partitions)
        return describe(model, prepared, samples_per_cluster, scored_path)
    finally:
        remove(spark, path)


def score_batch(
    spark: SparkSession,
    products: DataFrame,
    model_path: str,
    results_path: str,
    centers_path: str,
    run_id: str,
    features=None,
    id_style: str = "code",
    method: str | None = None,
    remove_outliers: bool = False,
    min_fill: float | None = None,
    percent: int = 100,
    limit: int = 0,
    **training,
) -> Report:
    """Score a batch with the saved model (trained on it if there is none) and store the run.

    The saved model says which features it reads, in which order, and how it scales.  ``features``
    (in any order) and ``method`` are only checked against it; a batch that cannot give a
    feature is an error.  Without a model they are what training uses, as do ``min_fill`` and the
    other training arguments.  ``percent``, ``limit`` and ``remove_outliers`` choose rows in both.
    """
    path = scratch_path(spark, "prepared")
    try:
        model = clustering.load_or_fit(spark, model_path)
        if model is None:
            wanted = tuple(features or FEATURES)
            some = chosen(products, wanted, percent, limit)
            rows = prepare_features(some, wanted, remove_outliers=remove_outliers, min_fill=min_fill)
            # Training reads the batch several times; scoring alone reads it once.
            prepared = stored(rows, path)
            found = tuple(f for f in wanted if min_fill is None or f in rows.columns)
            training["method"] = method or DEFAULT_METHOD
            model = clustering.load_or_fit(
                spark, model_path, lambda: clustering.fit(prepared, found, **training)
            )
        else:
            signed = clustering.signature(model)
            signed.accepts(features, method)
            some = chosen(products, signed.features, percent, limit)
            prepared = prepare_features(some, signed.features, remove_outliers=remove_outliers)
        report = describe(model, prepared)
    finally:
        remove(spark, path)
    write_results(report.scored, results_path, run_id, id_style)
    write_centers(report.centers, centers_path, run_id)
    return report


@dataclass(frozen=True)
class EtlCounts:
    """Rows chosen from the source, rows left by cleaning, and rows added to the target.

    ``written`` is exact; the others may count rows again that a lost executor held.
    """

    read: int
    kept: int
    written: int


def etl(
    spark: SparkSession,
    source: str,
    target: str,
    fmt: str = "parquet",
    percent: int = 100,
    limit: int = 0,
    features=FEATURES,
    remove_outliers: bool = False,
    **reading,
) -> EtlCounts:
    """Prepare raw products and append the new ones to the product table.

    Everything is loaded unless ``percent`` or ``limit`` asks for less.  The counts come with the
    load's own jobs.
    """
    products = read_products(spark, source, fmt, features, **reading)
    rows = chosen(extract_features(products, features, "nested"), features, percent, limit)
    # Counted behind the extraction: in front of it the scan would read whole nested records.
    rows, seen = observed(rows, "read", ())
    prepared = prepare_features(rows, features, remove_outliers=remove_outliers)
    loaded = append_products(prepared, target, features=features)
    return EtlCounts(seen.get["rows"], loaded.offered, loaded.written)


def insert_batch(products: DataFrame, n: int = DEFAULT_BATCH_ROWS, features=FEATURES) -> DataFrame:
    """The first ``n`` prepared products as product-table rows."""
    return product_rows(head_by_key(prepare_features(products, features), n), features)


def load_batch(products: DataFrame, target: str, n: int = DEFAULT_BATCH_ROWS) -> int:
    """Append a small batch of products not stored yet; returns the number of rows added."""
    return append_products(head_by_key(prepare_features(products), n), target).written


def validated_read(table: DataFrame, features=FEATURES) -> DataFrame:
    """Stored products with at least one positive measurement."""
    return any_positive(table, features)


def validated_rows(table: DataFrame, features=FEATURES) -> DataFrame:
    """The same rows as JSON objects, all of them."""
    return rows_to_json(validated_read(table, features))


def count_words(spark: SparkSession, source: str, target: str) -> None:
    """Text files in, ``word,count`` lines out."""
    write_word_counts(word_count(read_lines(spark, source)), target)
