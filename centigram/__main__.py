"""Command line for spark-submit: train, score, etl and count-words.

    spark-submit -m centigram train --source products.parquet --save models/current
    spark-submit -m centigram score --source batch.parquet --model models/current/model ...
    spark-submit -m centigram etl --source products.parquet --target tables/products
    spark-submit -m centigram count-words --source lines.txt --target counts

Session settings come from spark-submit; nothing here overrides them.
"""

import argparse

from pyspark.sql import DataFrame, SparkSession

from centigram.plans import jobs
from centigram.schemas import (
    DEFAULT_K,
    DEFAULT_MAX_ITER,
    DEFAULT_METHOD,
    DEFAULT_SEED,
    FEATURES,
    RAW_PRODUCTS,
    flat_products,
)
from centigram.sources.exchange import read_json_rows
from centigram.sources.products import read_products, read_table, sample_products


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="centigram")
    commands = top.add_subparsers(dest="command", required=True)
    train = commands.add_parser("train", help="fit a model and print its report")
    score = commands.add_parser("score", help="score a batch with a saved model")
    etl = commands.add_parser("etl", help="prepare and append products")
    words = commands.add_parser("count-words", help="count words of text files")

    files = ("parquet", "csv", "json")
    for command in (train, score, etl):
        formats = files if command is etl else (*files, "catalog", "json-rows")
        command.add_argument("--format", default="parquet", choices=formats)
        command.add_argument(
            "--features",
            # A saved model knows its own; then these are only checked against it.
            default=None if command is score else FEATURES,
            type=lambda s: tuple(s.split(",")),
        )
        command.add_argument("--percent", type=int, default=100, help="share of the keys")
        command.add_argument("--limit", type=int, default=0, help="first rows in key order")
        command.add_argument("--remove-outliers", action="store_true")
    for command in (train, score):
        command.add_argument("--k", type=int, default=DEFAULT_K)
        command.add_argument("--method", default=None if command is score else DEFAULT_METHOD)
        command.add_argument("--min-fill", type=float, help="use only features filled this often")
        command.add_argument("--max-iter", type=int, default=DEFAULT_MAX_ITER)
        command.add_argument("--seed", type=int, default=DEFAULT_SEED)
        command.add_argument("--partitions", type=int, help="tasks of a k-means iteration")
        command.add_argument("--json", help="folder for scored rows and centres as JSON")
        source = command.add_mutually_exclusive_group(required=True)
        source.add_argument("--source", help="path, or table name with --format catalog")
        source.add_argument("--sample", action="store_true", help="use the built-in smoke rows")
    for command in (train, score, etl, words):
        command.add_argument("--checkpoint-dir", help="shared folder for scratch tables")

    train.add_argument("--save", help="folder for the model and the tables of the report")

    for name in ("model", "results", "centers", "run-id"):
        score.add_argument(f"--{name}", required=True)
    score.add_argument("--id-style", default="code", choices=("code", "int", "long"))

    etl.add_argument("--source", required=True)
    etl.add_argument("--target", required=True)

    words.add_argument("--source", required=True)
    words.add_argument("--target", required=True)
    return top


def reading(args) -> dict:
    """Explicit schemas for the formats that carry none."""
    schemas = {"csv": flat_products(args.features or FEATURES), "json": RAW_PRODUCTS}
    return {"schema": schemas[args.format]} if args.format in schemas else {}


def products_of(spark: SparkSession, args) -> DataFrame:
    features = args.features or FEATURES
    if args.sample:
        return sample_products(spark, features)
    if args.format == "catalog":
        return read_table(spark, args.source, "catalog")
    if args.format == "json-rows":
        return read_json_rows(spark, args.source, flat_products(features))
    return read_products(spark, args.source, args.format, features, **reading(args))


def main(arguments=None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("centigram").getOrCreate()
    if args.checkpoint_dir:
        spark.sparkContext.setCheckpointDir(args.checkpoint_dir)
    if args.command == "count-words":
        jobs.count_words(spark, args.source, args.target)
        return
    if args.command == "etl":
        counts = jobs.etl(
            spark,
            args.source,
            args.target,
            args.format,
            args.percent,
            args.limit,
            args.features,
            args.remove_outliers,
            **reading(args),
        )
        print(f"read {counts.read}, kept {counts.kept}, written {counts.written}")
        return
    training = {
        "k": args.k,
        "method": args.method,
        "max_iter": args.max_iter,
        "seed": args.seed,
        "partitions": args.partitions,
        "remove_outliers": args.remove_outliers,
        "min_fill": args.min_fill,
        "percent": args.percent,
        "limit": args.limit,
    }
    products = products_of(spark, args)
    if args.command == "score":
        report = jobs.score_batch(
            spark,
            products,
            args.model,
            args.results,
            args.centers,
            args.run_id,
            args.features,
            args.id_style,
            **training,
        )
    else:
        report = jobs.train_report(products, args.features, **training)
        if args.save:
            jobs.save_report(report, args.save)
    if args.json:
        jobs.export_json(report, args.json)
    report.metrics.show(truncate=False)
    report.detail.orderBy("cluster", "sample").show(report.detail.count(), truncate=False)
    report.close()


if __name__ == "__main__":
    main()
