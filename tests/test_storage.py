import glob
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from centigram.__main__ import main
from centigram.functions.json_rows import (
    CORRUPT,
    centers_from_json,
    rows_from_json,
    rows_from_responses,
    rows_to_json,
)
from centigram.functions.keys import product_id
from centigram.operators import clustering
from centigram.operators.nested import prepare_features
from centigram.operators.text import text_lines, word_count
from centigram.plans import jobs
from centigram.schemas import (
    FEATURES,
    RAW_PRODUCTS,
    SAMPLE_PRODUCTS,
    STORED_CENTERS,
    STORED_RESULTS,
    flat_products,
    stored_products,
)
from centigram.sinks import scratch, tables
from centigram.sources.exchange import read_json_rows
from centigram.sources.products import (
    jdbc_options,
    read_lines,
    read_products,
    read_table,
    sample_products,
)


def types(schema):
    return [(f.name, f.dataType) for f in schema.fields]


# --- sources ---


def test_sample_products(spark):
    df = sample_products(spark)
    assert types(df.schema) == types(flat_products()) and df.count() == 5
    assert df.filter("code = '3'").first()["energy-kcal"] == 300.0
    assert sample_products(spark, ("a", "b", "c", "d", "e")).columns[2:] == list("abcde")
    with pytest.raises(ValueError):
        sample_products(spark, ("a",))


def test_projection_in_every_format(spark, tmp_path):
    df = sample_products(spark).withColumn("other", F.lit("x"))
    schema = T.StructType(flat_products().fields + [T.StructField("other", T.StringType())])
    df.write.parquet(str(tmp_path / "p"))
    df.write.csv(str(tmp_path / "c"), sep="\t", header=True)
    df.write.json(str(tmp_path / "j"))
    for fmt, kwargs in (
        ("parquet", {}),
        ("csv", {"schema": schema}),
        ("csv", {"infer": True}),
        ("json", {"schema": schema}),
        ("json", {"infer": True}),
    ):
        out = read_products(spark, str(tmp_path / fmt[0]), fmt, **kwargs)
        assert set(out.columns) == {"code", "product_name", *FEATURES}
        assert out.agg(F.sum("fat")).first()[0] == 75.0


def test_csv_without_schema_is_text(spark, tmp_path):
    sample_products(spark).write.csv(str(tmp_path / "c"), sep="\t", header=True)
    assert dict(read_products(spark, str(tmp_path / "c"), "csv").dtypes)["fat"] == "string"


def test_csv_header_must_match_the_schema(spark, tmp_path):
    sample_products(spark).select("product_name", "code").write.csv(
        str(tmp_path / "c"), sep="\t", header=True
    )
    schema = T.StructType(flat_products().fields[:2])
    with pytest.raises(Exception):
        read_products(spark, str(tmp_path / "c"), "csv", schema=schema).collect()


def test_unsupported_source(spark):
    with pytest.raises(ValueError):
        read_products(spark, "x", "xml")
    with pytest.raises(ValueError):
        read_products(spark, "x", "json")


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "t", user="u")
    assert plain == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "10000", "user": "u"}
    split = jdbc_options("jdbc:x", "t", "id", 0, 100, 8)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "id")


def test_catalog_table(spark):
    sample_products(spark).createOrReplaceTempView("sample_view")
    assert read_table(spark, "sample_view", "catalog").count() == 5


# --- JSON ---


def test_json_rows_keep_every_field_and_row(spark):
    df = spark.createDataFrame(
        [("1", None, Vectors.dense(1.0, 2.0)), ("2", 3.0, Vectors.sparse(2, [0], [5.0]))],
        T.StructType(
            [
                T.StructField("code", T.StringType()),
                T.StructField("fat", T.DoubleType()),
                T.StructField("features", VectorUDT()),
            ]
        ),
    )
    assert [r["value"] for r in rows_to_json(df).collect()] == [
        '{"code":"1","fat":null}',
        '{"code":"2","fat":3.0}',
    ]
    kept = [r["value"] for r in rows_to_json(df, keep_vectors=True).collect()]
    assert kept[1] == '{"code":"2","fat":3.0,"features":[5.0,0.0]}'


def test_json_parsing(spark):
    lines = spark.createDataFrame(
        [
            ('{"code":"1","fat":1,"ok":true,"list":[1.0,2.0]}',),
            ('{"code":"2"}',),
            ('{"code":"3","fat":',),
        ],
        "value string",
    )
    schema = T.StructType.fromDDL("code string, fat double, ok boolean, list string")
    rows = rows_from_json(lines, schema).collect()
    assert tuple(rows[0]) == ("1", 1.0, True, "[1.0,2.0]", None)
    assert tuple(rows[1]) == ("2", None, None, None, None)
    assert rows[2][CORRUPT] == '{"code":"3","fat":'


def test_json_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    tables.write_json_rows(sample_products(spark), path)
    back = read_json_rows(spark, path, flat_products())
    assert sorted(map(tuple, back.collect())) == sorted(SAMPLE_PRODUCTS)
    tables.write_json_rows(sample_products(spark), path, max_rows=2)
    assert spark.read.text(path).count() == 2
    (tmp_path / "bad").write_text('{"code": "1"}\n{"code"\n')
    with pytest.raises(Exception):
        read_json_rows(spark, str(tmp_path / "bad"), flat_products()).collect()
    loose = read_json_rows(spark, str(tmp_path / "bad"), flat_products(), strict=False)
    assert loose.filter(F.col(CORRUPT).isNotNull()).count() == 1


# --- keys ---


def test_product_ids(spark):
    df = spark.createDataFrame([("a", 7), ("b", 8), (None, 9)], "code string, id int")
    codes = df.select(product_id(df).alias("i")).collect()
    assert [r["i"] for r in codes] == ["a", "b", None]
    assert [r["i"] for r in df.select(product_id(df, "int").alias("i")).collect()] == [7, 8, 9]
    only_code = df.drop("id")
    hashed = only_code.select(product_id(only_code, "int").alias("i")).collect()
    expected = only_code.select(F.abs(F.hash("code") % 2147483647).alias("i")).collect()
    assert [r["i"] for r in hashed[:2]] == [r["i"] for r in expected[:2]]
    assert all(0 <= r["i"] < 2147483647 for r in hashed[:2]) and hashed[2]["i"] is not None
    long = only_code.select(product_id(only_code, "long").alias("i"), F.xxhash64("code").alias("h"))
    assert [r["i"] == r["h"] for r in long.collect()[:2]] == [True, True]
    nothing = df.select(F.lit(1).alias("x"))
    for style in ("code", "int", "long"):
        ids = nothing.select(product_id(nothing, style).alias("i")).collect()
        assert len({r["i"] for r in ids}) == 3
    with pytest.raises(ValueError):
        product_id(df, "other")


# --- sinks ---


def test_append_products_once(spark, tmp_path):
    path = str(tmp_path / "products")
    df = sample_products(spark)
    tables.append_products(df.limit(2), path)
    tables.append_products(df, path)
    tables.append_products(df, path)
    stored = read_table(spark, path)
    assert stored.count() == 5 and types(stored.schema) == types(stored_products())
    tables.append_products(df, path, once=False)
    assert read_table(spark, path).count() == 10


def test_rows_without_a_key_are_always_new(spark, tmp_path):
    path = str(tmp_path / "products")
    df = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "code string, fat double")
    tables.append_products(df, path)
    tables.append_products(df, path)
    assert read_table(spark, path).filter("code IS NULL").count() == 2
    assert read_table(spark, path).count() == 3


def test_runs_replace_themselves_only(spark, tmp_path):
    path = str(tmp_path / "results")
    df = spark.range(1000).select(
        F.format_string("%04d", 999 - F.col("id")).alias("code"), F.lit(1).alias("cluster")
    )
    tables.write_results(df, path, "a")
    tables.write_results(df.limit(10), path, "b")
    tables.write_results(df.limit(20), path, "a")
    stored = read_table(spark, path)
    assert types(stored.schema)[:4] == types(STORED_RESULTS)
    sizes = {r["run_id"]: r["count"] for r in stored.groupBy("run_id").count().collect()}
    assert sizes == {"a": 20, "b": 10}


def test_run_files_are_sorted_by_the_lookup_key(spark, tmp_path):
    path = str(tmp_path / "results")
    df = spark.range(1000).select(
        F.format_string("%04d", 999 - F.col("id")).alias("code"), F.lit(1).alias("cluster")
    )
    tables.write_results(df.repartition(3), path, "a")
    files = glob.glob(f"{path}/run_id=a/*.parquet")
    assert len(files) == 3
    for file in files:
        ids = pq.ParquetFile(file).read(["product_id"]).column(0).to_pylist()
        assert ids == sorted(ids)


def test_center_rows_count_from_zero(spark, tmp_path):
    df = spark.createDataFrame([(0, "fat", 1.5)], "cluster int, feature string, value double")
    tables.write_centers(df, str(tmp_path / "c"), "r")
    stored = read_table(spark, str(tmp_path / "c"))
    assert types(stored.schema)[:4] == types(STORED_CENTERS)
    assert stored.first()["cluster_id"] == 0


@pytest.mark.parametrize("rows", [0, 7])
def test_bounded_extract(spark, tmp_path, rows):
    path = str(tmp_path / "extract")
    df = spark.range(rows).select(F.col("id").cast("string").alias("code"))
    tables.bounded_extract(df, path, 5, "code")
    back = spark.read.parquet(path)
    assert back.columns == ["code"] and back.count() == min(rows, 5)
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        if meta.num_rows:
            column = meta.row_group(0).column(0)
            assert column.compression == "ZSTD" and column.statistics is not None


def test_seed_if_empty(spark, tmp_path):
    path = str(tmp_path / "products")
    assert tables.seed_if_empty(spark, path)
    assert not tables.seed_if_empty(spark, path)
    assert read_table(spark, path).count() == 5


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert configured in scratch.shared_folder(spark)


# --- text ---


def test_word_count_of_a_file(spark, tmp_path):
    (tmp_path / "in.txt").write_text("hello spark hello world\n")
    jobs.count_words(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"))
    counts = spark.read.csv(str(tmp_path / "out")).collect()
    assert {tuple(r) for r in counts} == {("hello", "2"), ("spark", "1"), ("world", "1")}


def test_empty_tokens_count(spark):
    df = spark.createDataFrame([(" a  b ",), ("",)], "value string")
    counts = {r["word"]: r["count"] for r in word_count(df).collect()}
    assert counts == {"": 4, "a": 1, "b": 1}


@pytest.mark.parametrize("text", ["a b\nb\n", "a b\r\nb\r\n", "a\rb b", "a\n\nb b", "\na b", "a\n\n"])
def test_multi_line_text_counts_like_a_file(spark, tmp_path, text):
    (tmp_path / "in.txt").write_bytes(text.encode())
    whole = spark.createDataFrame([(text,)], "text string")
    lines = read_lines(spark, str(tmp_path / "in.txt"))
    assert [r["value"] for r in text_lines(whole, "text").collect()] == [
        r["value"] for r in lines.collect()
    ]
    # a blank line is one empty token, in a file as in a column
    tokens = lines.select(F.explode(F.split("value", " ")).alias("word"))
    expected = {r["word"]: r["count"] for r in tokens.groupBy("word").count().collect()}
    counted = {r["word"]: r["count"] for r in word_count(text_lines(whole, "text")).collect()}
    assert counted == expected
    jobs.count_words(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"))
    stored = spark.read.csv(str(tmp_path / "out"), schema="word string, count long", nullValue="-", emptyValue="")
    assert {r["word"] or "": r["count"] for r in stored.collect()} == expected


# --- jobs ---


@pytest.fixture
def products(spark, raw):
    def values(i):
        return [("energy-kcal", 10.0 * i), ("fat", float(i % 9)), ("sugars", float(i % 4))]

    return raw(*[(f"{i:03d}", [f"p{i}"], values(i)) for i in range(200)])


def test_train_report(spark, products):
    report = jobs.train_report(products, k=3)
    assert report.scored.count() == 200
    assert sum(r["size"] for r in report.sizes.collect()) == 200
    assert report.centers.count() == 15 and report.samples.count() == 15
    metrics = report.metrics.first()
    assert metrics["cluster_count"] == 3 and -1 <= metrics["silhouette_score"] <= 1
    assert sum(metrics["cluster_sizes"].values()) == 200
    assert report.detail.count() == 15


def test_report_takes_samples_when_asked(spark, products, monkeypatch):
    taken = []
    sampled = jobs.summaries.cluster_samples
    monkeypatch.setattr(jobs.summaries, "cluster_samples", lambda *a: taken.append(a) or sampled(*a))
    report = jobs.train_report(products, k=3, samples_per_cluster=2)
    assert report.metrics.count() == 1 and not taken
    assert report.samples.groupBy("cluster").count().where("count > 2").isEmpty()
    assert report.detail.count() == report.samples.count() and len(taken) == 1
    report.close()


def test_train_report_with_fewer_points_than_clusters(spark, raw):
    same = raw(*[(str(i), ["p"], [("fat", 1.0)]) for i in range(10)])
    report = jobs.train_report(same, k=5)
    metrics = report.metrics.first()
    assert metrics["cluster_count"] == 1 and metrics["silhouette_score"] is None


def test_score_batch_reuses_the_model(spark, products, tmp_path):
    model, results, centers = (str(tmp_path / n) for n in ("m", "r", "c"))
    for run in ("a", "b", "b"):
        jobs.score_batch(spark, products, model, results, centers, run, k=3)
    stored = read_table(spark, results)
    assert stored.count() == 400
    per_product = stored.groupBy("product_id").agg(F.count_distinct("cluster_id").alias("n"))
    assert per_product.filter("n > 1").count() == 0
    assert read_table(spark, centers).count() == 30


def test_a_saved_model_scores_by_its_own_features(spark, products, tmp_path):
    report = jobs.train_report(products, ("sugars", "fat"), k=3, method="minmax")
    model = str(tmp_path / "m")
    clustering.save_model(report.model, model)
    signed = clustering.signature(PipelineModel.load(model))
    assert signed == clustering.Signature(("sugars", "fat"), "minmax", 3)
    places = [str(tmp_path / n) for n in "rc"]
    want = sorted(map(tuple, report.centers.collect()))
    for run, features in (("default", None), ("permuted", ("fat", "sugars"))):
        scored = jobs.score_batch(spark, products, model, *places, run, features=features)
        assert sorted(map(tuple, scored.centers.collect())) == want
        assert scored.features == ("sugars", "fat")
    runs = read_table(spark, places[0]).groupBy("product_id").agg(F.count_distinct("cluster_id").alias("n"))
    assert runs.filter("n > 1").isEmpty()
    for wrong in ({"features": ("fat",)}, {"features": ("fat", "salt")}, {"method": "standard"}):
        with pytest.raises(ValueError, match="the model"):
            jobs.score_batch(spark, products, model, *places, "wrong", **wrong)
    with pytest.raises(ValueError, match="sugars"):
        clustering.score(report.model, report.scored.select("code", "fat"))


def test_a_model_of_other_stages_has_no_signature(spark, products):
    report = jobs.train_report(products, k=2)
    with pytest.raises(ValueError, match="not a model"):
        clustering.signature(PipelineModel(stages=report.model.stages[:2]))


def test_score_batch_trains_on_well_filled_features(spark, products, tmp_path):
    places = [str(tmp_path / n) for n in "mrc"]
    first = jobs.score_batch(spark, products, *places, "a", min_fill=0.5, k=3)
    again = jobs.score_batch(spark, products, *places, "b")
    assert first.features == again.features and len(first.features) < len(FEATURES)


def test_training_and_scoring_choose_rows(spark, products, tmp_path):
    places = [str(tmp_path / n) for n in "mrc"]
    report = jobs.train_report(products, k=2, percent=50, limit=30)
    assert report.scored.count() == 30
    assert jobs.score_batch(spark, products, *places, "a", limit=40, k=2).scored.count() == 40
    assert jobs.score_batch(spark, products, *places, "a", percent=50).scored.count() < 150
    stored = read_table(spark, places[1])
    assert stored.count() < 150


def test_etl_and_validated_read(spark, products, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    products.write.parquet(source)
    for _ in range(2):
        jobs.etl(spark, source, target, percent=100, limit=0)
    table = read_table(spark, target)
    assert table.count() == 200
    # product 0 has no positive measurement
    assert jobs.validated_read(table).count() == 199
    assert jobs.validated_rows(table).count() == 199
    jobs.etl(spark, source, str(tmp_path / "u"), percent=50, limit=10)
    assert read_table(spark, str(tmp_path / "u")).count() == 10


def test_load_batch(spark, products, tmp_path):
    assert jobs.load_batch(products, str(tmp_path / "t"), 7) == 7
    assert jobs.load_batch(products, str(tmp_path / "t")) == 3
    assert jobs.load_batch(products, str(tmp_path / "t")) == 0
    assert read_table(spark, str(tmp_path / "t")).count() == 10


def test_key_styles_share_a_table(spark, numbers, tmp_path):
    rows = numbers([("a", 0, 1.0, 2.0), ("b", 1, 3.0, 4.0)])
    for style in ("code", "int", "long"):
        tables.write_results(rows, str(tmp_path / "t"), style, style)
    stored = read_table(spark, str(tmp_path / "t"))
    assert stored.filter("product_key IS NULL").select("run_id", "product_id").distinct().count() == 2
    assert stored.filter("product_id = CAST(product_key AS STRING)").count() == 4


def test_an_empty_run_replaces_its_earlier_rows(spark, numbers, tmp_path):
    rows = numbers([("a", 0, 1.0, 2.0), ("b", 1, 3.0, 4.0)])
    for run in ("x/1", "y"):
        tables.write_run(rows, str(tmp_path / "t"), run)
    tables.write_run(rows.limit(0), str(tmp_path / "t"), "x/1")
    left = read_table(spark, str(tmp_path / "t"))
    assert {(r["run_id"], r["code"]) for r in left.collect()} == {("y", "a"), ("y", "b")}


def test_a_failing_run_leaves_the_earlier_one(spark, numbers, tmp_path):
    path = str(tmp_path / "t")
    rows = numbers([("a", 0, 1.0, 2.0), ("b", 1, 3.0, 4.0)])
    assert [tables.write_run(rows, path, run) for run in ("one", "two")] == [2, 2]
    error = F.raise_error(F.lit("broken row")).cast("double")
    broken = rows.repartition(2).withColumn("x", F.when(F.col("code") == "b", error).otherwise(F.col("x")))
    with pytest.raises(Exception, match="broken row"):
        tables.write_run(broken, path, "one")
    left = read_table(spark, path).select("run_id", "code", "x").collect()
    assert sorted(map(tuple, left)) == [("one", "a", 1.0), ("one", "b", 3.0), ("two", "a", 1.0), ("two", "b", 3.0)]
    assert tables.write_run(rows.filter("code = 'a'"), path, "one") == 1
    assert read_table(spark, path).filter("run_id = 'one'").count() == 1


@pytest.mark.parametrize("run", ["a b", "x/1", "50%", "k=v", "größe", "it's"])
def test_run_names(spark, numbers, tmp_path, run):
    path = str(tmp_path / "t")
    rows = numbers([("a", 0, 1.0, 2.0), ("b", 1, 3.0, 4.0)])
    assert [tables.write_run(rows, path, name) for name in ("kept", run, run)] == [2, 2, 2]
    assert Path(tables.run_folder(path, run)).is_dir()
    assert read_table(spark, path).filter(F.col("run_id") == run).count() == 2
    assert tables.write_run(rows.limit(0), path, run) == 0
    assert [r["run_id"] for r in read_table(spark, path).select("run_id").distinct().collect()] == ["kept"]


def test_a_run_needs_a_name(numbers, tmp_path):
    with pytest.raises(ValueError, match="name"):
        tables.write_run(numbers([("a", 0, 1.0, 2.0)]), str(tmp_path / "t"), "")


def jobs_of(spark, action):
    group = f"counted-{id(action)}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        result = action()
    finally:
        spark.sparkContext.setJobGroup("rest", "rest")
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_counts_come_with_the_write(spark, tmp_path):
    df = spark.range(100).select(F.format_string("%03d", "id").alias("code"), F.lit(1.0).alias("fat"))
    counted, plain = str(tmp_path / "c"), str(tmp_path / "p")
    for path in (counted, plain):
        tables.append_products(df.filter("code < '040'"), path)

    def by_hand():
        rows = tables.new_rows(tables.product_rows(df), tables.table_or_none(spark, plain))
        rows.write.mode("append").parquet(plain)

    loaded, with_counts = jobs_of(spark, lambda: tables.append_products(df, counted))
    _, without = jobs_of(spark, by_hand)
    assert loaded == tables.Loaded(100, 60)
    assert with_counts == without
    assert tables.append_products(df, counted) == tables.Loaded(100, 0)
    assert tables.append_products(df.limit(0), counted) == tables.Loaded(0, 0)


def test_etl_counts(spark, products, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    products.write.parquet(source)
    total = products.count()
    first = jobs.etl(spark, source, target)
    assert first.read == total and first.written == first.kept == read_table(spark, target).count()
    again = jobs.etl(spark, source, target)
    assert (again.read, again.kept, again.written) == (total, first.kept, 0)
    assert jobs.etl(spark, source, str(tmp_path / "u"), limit=2).read == 2


def test_json_products(spark, products, tmp_path):
    products.write.json(str(tmp_path / "j"))
    back = read_products(spark, str(tmp_path / "j"), "json", schema=RAW_PRODUCTS)
    assert back.exceptAll(products).count() == 0


def test_report_reads_the_scored_table_once_for_each_small_table(spark, products):
    report = jobs.train_report(products, k=2)
    made = {name: getattr(report, name) for name in ("metrics", "detail", "shares", "sizes", "samples", "silhouettes")}
    for table in made.values():
        assert not any(f"{report.scratch[0]}/" in f for f in table.inputFiles())
    assert {r["cluster"]: r["size"] for r in made["sizes"].collect()} == {
        r["cluster"]: r["count"] for r in report.scored.groupBy("cluster").count().collect()
    }
    assert made["detail"].count() == made["samples"].count() > 0
    assert made["metrics"].first()["cluster_count"] == 2
    paths = list(report.scratch)
    report.close()
    assert len(paths) == 4 and not any(Path(p.removeprefix("file:")).exists() for p in paths)


def test_save_report(spark, products, tmp_path):
    report = jobs.train_report(products, k=2)
    jobs.save_report(report, str(tmp_path / "saved"))
    metrics = spark.read.json(str(tmp_path / "saved" / "metrics")).first()
    assert metrics["success"] and metrics["cluster_count"] == 2
    assert spark.read.text(str(tmp_path / "saved" / "model" / "metadata")).count() == 1
    for name in jobs.REPORT_TABLES:
        stored, table = read_table(spark, str(tmp_path / "saved" / name)), getattr(report, name)
        assert stored.columns == table.columns and stored.exceptAll(table).isEmpty()
    jobs.export_json(report, str(tmp_path / "json"))
    assert spark.read.text(str(tmp_path / "json" / "rows")).count() == 200
    centers = centers_from_json(spark.read.text(str(tmp_path / "json" / "centers")))
    assert centers.exceptAll(report.centers).isEmpty() and centers.count() == 10


def folders(spark):
    place = Path(scratch.shared_folder(spark).removeprefix("file:"))
    return {p.name for p in place.iterdir()} if place.exists() else set()


def test_a_closed_report_leaves_no_scratch_table(spark, products, tmp_path):
    before = folders(spark)
    report = jobs.train_report(products, k=2, min_fill=0.5)
    assert report.features == ("energy-kcal", "fat", "sugars")
    assert folders(spark) > before
    report.close()
    assert folders(spark) == before
    tables.bounded_extract(products, str(tmp_path / "e"), 2000, "code")
    products.write.parquet(str(tmp_path / "s"))
    jobs.etl(spark, str(tmp_path / "s"), str(tmp_path / "t"), limit=1500)
    assert read_table(spark, str(tmp_path / "t")).count() == 200
    assert folders(spark) == before


def test_a_full_load_keeps_rows_without_a_key(spark, raw, tmp_path):
    raw((None, ["a"], [("fat", 1.0)]), ("1", ["b"], None)).write.parquet(str(tmp_path / "s"))
    jobs.etl(spark, str(tmp_path / "s"), str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path / "t")).count() == 2


def test_responses(spark):
    good = [
        '{"success":true,"message":"ok","data":[{"code":"1","fat":1.5},{"code":"2"}]}',
        '{"success":true,"message":"ok","data":[]}',
    ]
    schema = T.StructType.fromDDL("code string, fat double")
    lines = spark.createDataFrame([(g,) for g in good], "value string")
    assert [tuple(r) for r in rows_from_responses(lines, schema).collect()] == [
        ("1", 1.5), ("2", None)
    ]
    for bad in ('{"success":false,"message":"no table","data":[]}', "not json"):
        failing = spark.createDataFrame([(bad,)], "value string")
        with pytest.raises(Exception, match="request failed"):
            rows_from_responses(failing, schema).collect()


def test_command_line(spark, products, tmp_path, capsys):
    source = str(tmp_path / "s")
    products.write.parquet(source)
    main(["train", "--source", source, "--k", "2", "--save", str(tmp_path / "saved")])
    main(["train", "--sample", "--k", "2"])
    paths = {n: str(tmp_path / n) for n in ("results", "centers")}
    main(
        ["score", "--source", source, "--model", str(tmp_path / "saved" / "model"), "--run-id", "r"]
        + [x for n, p in paths.items() for x in (f"--{n}", p)]
    )
    assert read_table(spark, paths["results"]).count() == 200
    rows = str(tmp_path / "rows")
    tables.write_json_rows(prepare_features(products), rows)
    again = ["score", "--model", str(tmp_path / "saved" / "model"), "--run-id", "r"]
    again += [x for n, p in paths.items() for x in (f"--{n}", p)]
    main([*again, "--source", rows, "--format", "json-rows", "--json", str(tmp_path / "json")])
    assert spark.read.text(str(tmp_path / "json" / "rows")).count() == 200
    main([*again, "--sample"])
    assert read_table(spark, paths["results"]).count() == 5
    main(["etl", "--source", source, "--target", str(tmp_path / "t"), "--percent", "100"])
    assert read_table(spark, str(tmp_path / "t")).count() == 200
    sample_products(spark).write.csv(str(tmp_path / "c"), sep="\t", header=True)
    main(["etl", "--source", str(tmp_path / "c"), "--target", str(tmp_path / "u"),
          "--percent", "100", "--format", "csv"])
    assert read_table(spark, str(tmp_path / "u")).count() == 5
    (tmp_path / "in.txt").write_text("a b a\n")
    main(["count-words", "--source", str(tmp_path / "in.txt"), "--target", str(tmp_path / "w")])
    assert spark.read.csv(str(tmp_path / "w")).count() == 2
    assert "Clustering completed successfully" in capsys.readouterr().out
