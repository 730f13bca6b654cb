"""One callable per query: (spark, folder of the tables) -> DataFrame."""

import functools
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.inputs import (
    clustered_products,
    nested_products,
    prepared_products,
    separated_products,
    table,
)
from centigram.functions.columns import col
from centigram.functions.json_rows import (
    CORRUPT,
    centers_from_json,
    centers_to_json,
    rows_from_json,
    rows_from_responses,
    rows_to_json,
)
from centigram.functions.keys import product_id
from centigram.functions.measurements import list_text
from centigram.operators import clustering, evaluation, quality, summaries
from centigram.operators.nested import (
    cast_flat,
    extract_features,
    feature_column,
    prepare_features,
)
from centigram.operators.sampling import hash_sample, head_by_key, sample_then_head
from centigram.operators.sampling import random_sample as random_sample_of
from centigram.operators.scaling import (
    assembler_stage,
    scale_columns,
    scaler_stage,
    vector_columns,
)
from centigram.operators.text import text_lines, word_count
from centigram.plans import jobs
from centigram.schemas import FEATURES, RAW_PRODUCTS, flat_products
from centigram.sinks import tables as sinks
from centigram.sinks.scratch import scratch_path, stored
from centigram.sources.exchange import read_json_rows
from centigram.sources.products import read_products, read_table

QUERIES = {}


def local_scratch(spark: SparkSession) -> None:
    """Give a local session without a checkpoint folder a temporary one."""
    context = spark.sparkContext
    unset = context.getCheckpointDir() is None and spark.conf.get("spark.checkpoint.dir", None) is None
    if unset and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="centigram-"))


def query(function):
    @functools.wraps(function)
    def run(spark, folder):
        local_scratch(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return function


def rounded(df: DataFrame, columns, decimals: int = 6) -> DataFrame:
    """Round for comparison; adding zero turns -0.0 into 0.0."""
    return df.withColumns({c: F.round(col(c), decimals) + F.lit(0.0) for c in columns})


def flat(spark: SparkSession, folder: str) -> DataFrame:
    return extract_features(nested_products(spark, folder))


# --- sources ---------------------------------------------------------------------------


@query
def scan_projection(spark, folder):
    wanted = ("p_partkey", "p_name", "p_size", "not_there")
    return read_products(spark, f"{folder}/part.parquet", features=wanted)


@query
def parquet_scan(spark, folder):
    path = scratch_path(spark, "products")
    nested_products(spark, folder).write.parquet(path)
    return prepare_features(read_products(spark, path))


@query
def csv_scan(spark, folder):
    path = scratch_path(spark, "products-csv")
    prepared_products(spark, folder).write.csv(path, sep="\t", header=True)
    return read_products(spark, path, "csv", schema=flat_products())


@query
def json_scan(spark, folder):
    path = scratch_path(spark, "products-json")
    nested_products(spark, folder).write.json(path, compression="gzip")
    return prepare_features(read_products(spark, path, "json", schema=RAW_PRODUCTS))


@query
def table_scan(spark, folder):
    path = scratch_path(spark, "product-table")
    sinks.append_products(prepared_products(spark, folder), path, once=False)
    return read_table(spark, path).drop("created_at")


# --- samples and limits ----------------------------------------------------------------


@query
def head_rows(spark, folder):
    return head_by_key(flat(spark, folder), 1000)


@query
def hash_sample_rows(spark, folder):
    return extract_features(hash_sample(nested_products(spark, folder), 10))


@query
def hash_sample_limit(spark, folder):
    return sample_then_head(flat(spark, folder), 10, 500)


@query
def insert_batch(spark, folder):
    return jobs.insert_batch(nested_products(spark, folder), 10).drop("created_at")


@query
def bounded_extract(spark, folder):
    path = scratch_path(spark, "extract")
    sinks.bounded_extract(nested_products(spark, folder), path, 5000, "code")
    return extract_features(read_products(spark, path))


@query
def random_sample(spark, folder):
    """A seeded tenth: about the right size, nothing that is not in the table, repeatable."""
    products = nested_products(spark, folder)
    tenth, again = (random_sample_of(products, 0.1, seed=7) for _ in range(2))
    rows = products.agg(F.count(F.lit(1)).alias("n"))
    strays = tenth.join(products.select("code").distinct(), "code", "left_anti")
    differs = tenth.select("code").exceptAll(again.select("code"))
    counts = tenth.agg(F.count(F.lit(1)).alias("sampled")).withColumns(
        {
            "n": rows.scalar(),
            "strays": strays.agg(F.count(F.lit(1)).alias("n")).scalar(),
            "differs": differs.agg(F.count(F.lit(1)).alias("n")).scalar(),
        }
    )
    near = (F.col("sampled") > F.col("n") * 0.08) & (F.col("sampled") < F.col("n") * 0.12)
    return counts.select(near.alias("near"), "strays", "differs")


# --- nested data and projections -------------------------------------------------------


@query
def extract_by_name(spark, folder):
    return flat(spark, folder).drop("product_name")


@query
def first_text(spark, folder):
    return flat(spark, folder).select("code", "product_name")


@query
def flat_or_nested(spark, folder):
    text = F.when(F.col("l_returnflag") == "A", "n/a").when(F.col("l_returnflag") == "N", "7.5")
    both = nested_products(spark, folder).withColumn("sugars", text)
    preferred = [
        feature_column(both, "sugars", prefer).alias(f"sugars_{prefer}")
        for prefer in ("flat", "nested", "row")
    ]
    return both.select("code", feature_column(both, "fat").alias("fat"), *preferred)


@query
def cast_flat_columns(spark, folder):
    value = F.col("value").cast("string")
    events = table(spark, folder, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k"),
        F.col("props").alias("raw"),
        F.when(F.col("event_type") == "error", "abc").otherwise(value).alias("mixed"),
    )
    return cast_flat(events, ("k", "raw", "mixed"))


@query
def prepare_features_rows(spark, folder):
    return prepared_products(spark, folder)


@query
def prepare_without_outliers(spark, folder):
    raw = nested_products(spark, folder)
    return prepare_features(raw, prefer="nested", remove_outliers=True, outlier_threshold=1.7)


@query
def product_load_rows(spark, folder):
    return sinks.product_rows(prepared_products(spark, folder)).drop("created_at")


@query
def list_text_rows(spark, folder):
    pair = F.array(F.col("p_partkey").cast("double"), F.col("p_size").cast("double"))
    return table(spark, folder, "part").select("p_partkey", list_text(pair).alias("pair"))


# --- filters and quality ---------------------------------------------------------------


@query
def prepare_well_filled(spark, folder):
    """Fat and carbohydrates are missing in about a fifth of the rows and go."""
    return prepare_features(nested_products(spark, folder), min_fill=0.9)


@query
def any_positive(spark, folder):
    return quality.any_positive(prepared_products(spark, folder))


@query
def complete_cases(spark, folder):
    return quality.complete_cases(flat(spark, folder))


@query
def zscore_filter(spark, folder):
    return quality.zscore_filter(prepared_products(spark, folder), threshold=1.5)


@query
def fill_rate(spark, folder):
    return rounded(quality.fill_rate(flat(spark, folder), threshold=0.9), ["rate"])


@query
def null_profile(spark, folder):
    return rounded(quality.null_profile(flat(spark, folder)), ["pct"])


@query
def kept_report(spark, folder):
    rows = flat(spark, folder)
    rules = {
        "any_positive": quality.any_positive_rule(rows),
        "complete": quality.complete_rule(rows),
        "within_1.5_sd": quality.zscore_rule(rows, threshold=1.5),
    }
    return rounded(quality.kept_report(rows, rules), ["removed_pct"])


@query
def feature_stats(spark, folder):
    return rounded(quality.feature_stats(flat(spark, folder)), ["mean", "stddev"])


@query
def row_count(spark, folder):
    return quality.row_count(nested_products(spark, folder))


@query
def validated_read(spark, folder):
    path = scratch_path(spark, "product-table")
    sinks.append_products(prepared_products(spark, folder), path, once=False)
    return jobs.validated_read(read_table(spark, path)).drop("created_at")


# --- scaling ---------------------------------------------------------------------------


def _scaled(spark, folder, method):
    scaled = scale_columns(prepared_products(spark, folder), method=method)
    names = [f"scaled_{f}" for f in FEATURES]
    return rounded(scaled.select("code", *[col(n) for n in names]), names)


@query
def scale_standard(spark, folder):
    return _scaled(spark, folder, "standard")


@query
def scale_minmax(spark, folder):
    return _scaled(spark, folder, "minmax")


@query
def scale_maxabs(spark, folder):
    return _scaled(spark, folder, "maxabs")


@query
def scale_robust(spark, folder):
    return _scaled(spark, folder, "robust")


@query
def scaled_vector_columns(spark, folder):
    assembled = assembler_stage().transform(prepared_products(spark, folder))
    scaled = scaler_stage("standard").fit(assembled).transform(assembled)
    names = [f"scaled_{f}" for f in FEATURES]
    return rounded(vector_columns(scaled).select("code", *[col(n) for n in names]), names)


# --- clustering ------------------------------------------------------------------------


@query
def assign_to_centers(spark, folder):
    rows = clustered_products(spark, folder)
    centers = summaries.centers_long(summaries.cluster_means(rows))
    assigned = clustering.assign_to_centers(rows, centers, k=3)
    return rounded(assigned.select("code", "cluster", "distance"), ["distance"])


@query
def silhouette_by_cluster(spark, folder):
    scores = evaluation.silhouette_by_cluster(clustered_products(spark, folder), k=4)
    return rounded(scores, ["silhouette"])


@query
def silhouette_many_clusters(spark, folder):
    """A cluster for every value of the carbohydrates, 0 to 50."""
    rows = prepared_products(spark, folder).withColumn("cluster", col("carbohydrates").cast("int"))
    return rounded(evaluation.silhouette_by_cluster(rows, k=51), ["silhouette"])


@query
def silhouette_overall(spark, folder):
    by_cluster = evaluation.silhouette_by_cluster(clustered_products(spark, folder), k=4)
    return rounded(evaluation.silhouette_overall(by_cluster), ["silhouette"])


def by_first_code(rows: DataFrame, scored: DataFrame, k: int = 3) -> DataFrame:
    """``rows`` with the clusters of ``scored`` renumbered by their lowest code.

    One aggregate row holds all lowest codes: no grouping, which would sort the table for a
    minimum of texts, and no join by cluster, which would deal the rows to ``k`` tasks.
    """
    codes = F.array(*[F.min(F.when(F.col("cluster") == i, F.col("code"))) for i in range(k)])
    firsts = scored.agg(codes.alias("firsts"))
    places = F.transform("firsts", lambda c: F.array_position(F.array_sort(F.array_compact("firsts")), c) - 1)
    numbers = firsts.select(places.cast("array<int>").alias("numbers")).scalar()
    renamed = rows.drop("cluster").columns
    return (
        rows.withColumn("_number", F.get(numbers, F.col("cluster")))
        .where(F.col("_number").isNotNull())
        .select(*[col(c) for c in renamed], F.col("_number").alias("cluster"))
    )


@query
def kmeans_fit_score(spark, folder):
    prepared = stored(prepare_features(separated_products(spark, folder)))
    scored = clustering.score(clustering.fit(prepared, k=3), prepared).select("code", "cluster")
    return by_first_code(scored, scored)


@query
def kmeans_invariants(spark, folder):
    """Facts every fitted model must satisfy, whatever its centres are."""
    report = jobs.train_report(nested_products(spark, folder))
    scaled = [f"scaled_{f}" for f in FEATURES]
    names = report.centers.withColumn("feature", F.concat(F.lit("scaled_"), "feature"))
    nearest = clustering.assign_to_centers(
        report.scored.withColumn("predicted", F.col("cluster")), names, features=scaled
    )
    largest_mean = F.greatest(*[F.abs(F.avg(col(s))) for s in scaled])
    row = nearest.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("predicted") != F.col("cluster")).alias("not_nearest"),
        (largest_mean < 1e-9).alias("centred"),
    )
    sized = F.sum("size").alias("sized_rows"), F.count(F.lit(1)).alias("clusters")
    sizes = report.sizes.agg(F.struct(*sized).alias("s")).scalar()
    return row.withColumns({"sized_rows": sizes["sized_rows"], "clusters": sizes["clusters"]})


@query
def train_report(spark, folder):
    """The report of three groups far apart: shares, centres in scaled units, samples."""
    report = jobs.train_report(separated_products(spark, folder), k=3)
    return by_first_code(report.detail, report.scored)


@query
def saved_report(spark, folder):
    """The box plots of the same run, read back from the saved report."""
    path = scratch_path(spark, "report")
    report = jobs.train_report(separated_products(spark, folder), k=3)
    jobs.save_report(report, path)
    box = by_first_code(read_table(spark, f"{path}/distribution"), report.scored)
    return rounded(box, ["q1", "median", "q3", "whisker_low", "whisker_high"])


@query
def train_report_metrics(spark, folder):
    """Cluster count and silhouette of the same run."""
    report = jobs.train_report(separated_products(spark, folder), k=3)
    metrics = report.metrics.select("success", "message", "cluster_count", "silhouette_score")
    return rounded(metrics, ["silhouette_score"])


@query
def score_batch(spark, folder):
    """Train once, score again from the saved model, and read the stored run back."""
    model, results, centers = (scratch_path(spark, n) for n in ("model", "results", "centers"))
    products = nested_products(spark, folder)
    for run in ("first", "second"):
        jobs.score_batch(spark, products, model, results, centers, run)
    in_run = {
        run: F.sum(F.when(F.col("run_id") == run, F.col("cluster_id"))) for run in ("first", "second")
    }
    return read_table(spark, results).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("results"), (in_run["first"] == in_run["second"]).alias("repeats")
    )


def separated_run(spark, products, model, **scoring) -> tuple[DataFrame, DataFrame]:
    """Score three groups far apart; results and centres as stored, numbered by first code."""
    results, centers = scratch_path(spark, "results"), scratch_path(spark, "centers")
    jobs.score_batch(spark, products, model, results, centers, "run", **scoring).close()
    scored = read_table(spark, results).selectExpr("product_id AS code", "cluster_id AS cluster")
    named = read_table(spark, centers).selectExpr(
        "cluster_id AS cluster", "feature_name AS feature", "feature_value AS value"
    )
    return by_first_code(scored, scored), by_first_code(named, scored)


@query
def score_reduced_model(spark, folder):
    """A model trained on well-filled features only scores complete products by default arguments."""
    model, whole = scratch_path(spark, "model"), separated_products(spark, folder)
    some = F.crc32(F.col("code").cast("binary")) % 4 != 0
    gaps = whole.withColumns({f: F.when(some, F.col(f)) for f in ("fat", "carbohydrates")})
    report = jobs.train_report(gaps, k=3, min_fill=0.9)
    clustering.save_model(report.model, model)
    report.close()
    scored, centers = separated_run(spark, whole, model)
    read = centers.groupBy("cluster").agg(F.array_join(F.sort_array(F.collect_list("feature")), ",").alias("features"))
    return scored.join(read, "cluster")


@query
def score_permuted_features(spark, folder):
    """Stored centres of a batch whose caller names the model's features in another order."""
    model, products = scratch_path(spark, "model"), separated_products(spark, folder)
    report = jobs.train_report(products, k=3)
    clustering.save_model(report.model, model)
    report.close()
    _, centers = separated_run(spark, products, model, features=tuple(reversed(FEATURES)))
    return rounded(centers, ["value"])


# --- summaries -------------------------------------------------------------------------


@query
def cluster_sizes(spark, folder):
    return summaries.cluster_sizes(clustered_products(spark, folder), k=4)


@query
def cluster_share(spark, folder):
    return summaries.cluster_share(
        summaries.cluster_sizes(clustered_products(spark, folder), k=4)
    )


@query
def cluster_distinct(spark, folder):
    return summaries.cluster_distinct(clustered_products(spark, folder))


@query
def cluster_samples(spark, folder):
    return summaries.cluster_samples(clustered_products(spark, folder), 5)


@query
def cluster_samples_large(spark, folder):
    return summaries.cluster_samples(clustered_products(spark, folder), 1500)


@query
def distribution_by_cluster(spark, folder):
    box = summaries.distribution_by_cluster(clustered_products(spark, folder))
    return rounded(box, ["q1", "median", "q3", "whisker_low", "whisker_high"])


@query
def density_2d_by_cluster(spark, folder):
    rows = clustered_products(spark, folder)
    return summaries.density_2d_by_cluster(rows, "energy-kcal", "fat", bins=50)


@query
def head_rows_large(spark, folder):
    """More rows than a map task prunes to: stored by range, ranked in each range."""
    return head_by_key(flat(spark, folder), 5000)


@query
def cluster_means(spark, folder):
    return rounded(summaries.cluster_means(clustered_products(spark, folder)), FEATURES)


@query
def centers_long(spark, folder):
    means = summaries.cluster_means(clustered_products(spark, folder))
    return rounded(summaries.centers_long(means), ["value"])


@query
def centers_wide(spark, folder):
    means = summaries.cluster_means(clustered_products(spark, folder))
    return summaries.centers_wide(summaries.centers_long(means))


@query
def centers_json_round_trip(spark, folder):
    means = summaries.cluster_means(clustered_products(spark, folder))
    text = centers_to_json(summaries.centers_long(means), FEATURES)
    return rounded(centers_from_json(text), ["value"])


@query
def cluster_detail(spark, folder):
    rows = clustered_products(spark, folder)
    shares = summaries.cluster_share(summaries.cluster_sizes(rows, k=4))
    centers = summaries.centers_long(summaries.cluster_means(rows))
    return summaries.cluster_detail(shares, centers, summaries.cluster_samples(rows, 5))


@query
def run_metrics(spark, folder):
    rows = clustered_products(spark, folder)
    overall = evaluation.silhouette_overall(evaluation.silhouette_by_cluster(rows, k=4))
    metrics = summaries.run_metrics(summaries.cluster_sizes(rows, k=4), overall)
    sizes = [F.col("cluster_sizes")[str(i)].alias(f"size_{i}") for i in range(4)]
    kept = metrics.select("success", "cluster_count", "silhouette_score", *sizes)
    return rounded(kept, ["silhouette_score"])


@query
def result_rows(spark, folder):
    return sinks.result_rows(clustered_products(spark, folder)).drop("created_at", "product_key")


@query
def result_rows_int(spark, folder):
    """Two runs of different key styles in one table: text ids, and numbers only in one."""
    path = scratch_path(spark, "results")
    rows = clustered_products(spark, folder)
    sinks.write_results(rows, path, "text", "code")
    sinks.write_results(rows, path, "number", "int")
    stored = read_table(spark, path)
    same = F.col("product_id") == F.col("product_key").cast("string")
    return stored.groupBy("run_id", "cluster_id").agg(
        F.count(F.lit(1)).alias("results"), F.count_if(same).alias("numbers")
    )


@query
def product_id_styles(spark, folder):
    """Facts about the hashed keys: one per code, 64-bit ones distinct, 32-bit ones in range."""
    rows = clustered_products(spark, folder)
    ids = rows.select("code", *[product_id(rows, s).alias(s) for s in ("int", "long")]).distinct()
    in_range = (F.col("int") >= 0) & (F.col("int") < 2147483647)
    return ids.agg(
        F.count(F.lit(1)).alias("ids"),
        F.count_distinct("long").alias("long_ids"),
        F.count_if(~in_range).alias("outside"),
    )


# --- JSON exchange ---------------------------------------------------------------------


@query
def json_row_exchange(spark, folder):
    """Every row as JSON and back, with a flag that no row sets."""
    rows = jobs.validated_rows(prepared_products(spark, folder))
    parsed = rows_from_json(rows, flat_products())
    return parsed.withColumn("unreadable", F.col(CORRUPT).isNotNull()).drop(CORRUPT)


@query
def json_responses(spark, folder):
    """Every product in a response document of its own, and back."""
    rows = rows_to_json(prepared_products(spark, folder))
    start, end = F.lit('{"success":true,"message":"ok","data":['), F.lit("]}")
    responses = rows.select(F.concat(start, "value", end).alias("value"))
    return rows_from_responses(responses, flat_products())


@query
def json_file_exchange(spark, folder):
    path = scratch_path(spark, "rows")
    rows = clustered_products(spark, folder)
    sinks.write_json_rows(rows, path)
    schema = T.StructType(flat_products().fields + [T.StructField("cluster", T.IntegerType())])
    return read_json_rows(spark, path, schema)


@query
def json_typed_values(spark, folder):
    """A cut-off object is flagged and keeps the fields that came before the cut."""
    broken = F.when(F.col("event_type") == "error", F.left("props", F.lit(4)))
    lines = table(spark, folder, "events").select(
        F.concat(
            F.lit('{"event_id": '),
            "event_id",
            F.lit(', "tags": ["x","y"], "props": '),
            F.coalesce(broken, F.col("props")),
            F.lit("}"),
        ).alias("value")
    )
    schema = T.StructType.fromDDL(
        "event_id bigint, props struct<k: double>, tags string, missing boolean"
    )
    parsed = rows_from_json(lines, schema)
    return parsed.groupBy(
        F.col(CORRUPT).isNotNull().alias("corrupt"),
        F.col("props.k").alias("k"),
        "missing",
    ).agg(F.count(F.lit(1)).alias("count"), F.count_if(F.col("tags") == '["x","y"]').alias("tags"))


# --- sinks and jobs --------------------------------------------------------------------


@query
def append_products(spark, folder):
    """A partial load, then the full load twice: every product is stored once."""
    path = scratch_path(spark, "product-table")
    products = prepared_products(spark, folder)
    sinks.append_products(hash_sample(products, 40), path)
    for _ in range(2):
        sinks.append_products(products, path)
    return read_table(spark, path).drop("created_at")


@query
def write_results(spark, folder):
    """Two runs, the first written twice: each run is stored once."""
    path = scratch_path(spark, "results")
    rows = clustered_products(spark, folder)
    sinks.write_results(rows, path, "a")
    sinks.write_results(rows.filter("cluster = 1"), path, "b")
    sinks.write_results(rows, path, "a")
    return read_table(spark, path).drop("created_at", "product_key")


@query
def write_results_empty_rerun(spark, folder):
    """Two runs, then the first again without its cluster 0, then the second with no rows."""
    path = scratch_path(spark, "results")
    rows = clustered_products(spark, folder)
    for run in ("a", "b"):
        sinks.write_results(rows, path, run)
    sinks.write_results(rows.filter("cluster <> 0"), path, "a")
    sinks.write_results(rows.filter("cluster < 0"), path, "b")
    return read_table(spark, path).drop("created_at", "product_key")


@query
def write_centers(spark, folder):
    path = scratch_path(spark, "centers")
    centers = summaries.centers_long(summaries.cluster_means(clustered_products(spark, folder)))
    for run in ("a", "b", "a"):
        sinks.write_centers(centers, path, run)
    return rounded(read_table(spark, path).drop("created_at"), ["feature_value"])


@query
def etl(spark, folder):
    source, target = (scratch_path(spark, n) for n in ("products", "product-table"))
    nested_products(spark, folder).write.parquet(source)
    for _ in range(2):
        jobs.etl(spark, source, target, percent=30, limit=4000)
    return read_table(spark, target).drop("created_at")


@query
def etl_full(spark, folder):
    """The whole load, twice, without any argument: every product once."""
    source, target = (scratch_path(spark, n) for n in ("products", "product-table"))
    nested_products(spark, folder).write.parquet(source)
    for _ in range(2):
        jobs.etl(spark, source, target)
    return read_table(spark, target).drop("created_at")


@query
def load_batch_twice(spark, folder):
    """The same small batch twice: its products are stored once."""
    target = scratch_path(spark, "product-table")
    for _ in range(2):
        jobs.load_batch(nested_products(spark, folder), target)
    return read_table(spark, target).drop("created_at")


@query
def word_count_documents(spark, folder):
    return word_count(text_lines(table(spark, folder, "documents"), "text"))


@query
def word_count_job(spark, folder):
    return counted_by_job(spark, text_lines(table(spark, folder, "documents"), "text"))


@query
def word_count_blank_lines(spark, folder):
    """Every line of every document followed by a blank one."""
    lines = text_lines(table(spark, folder, "documents"), "text")
    return counted_by_job(spark, lines.select(F.concat("value", F.lit("\n")).alias("value")))


def counted_by_job(spark: SparkSession, lines: DataFrame) -> DataFrame:
    source, target = (scratch_path(spark, n) for n in ("lines", "counts"))
    lines.write.text(source)
    jobs.count_words(spark, source, target)
    counts = spark.read.schema("word string, count bigint").csv(target)
    return counts.select(F.coalesce("word", F.lit("")).alias("word"), "count")
