"""Five corpus operators in a row, each over all that the one before it kept.

Quality classifier, near copies, personal data, mixing, encoding.  STAGES lists them; each
takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
for the next.  All but the last return the columns of `documents`; the last returns doc_id,
n_tokens, ids_sha256 and decoded_sha256, a row per drawn document.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from centigram.llm import bpe, jaccard, mixing, pii, ranking
from centigram.llm.common import discard, shared_folder
from centigram.llm.queries import table, tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Bradley-Terry ranking accepts."""
    return ranking.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.one_of_each(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per drawn document: whole documents, as near to the targets as they come."""
    return mixing.mixed_documents(docs, mixing.mix(docs, whole_documents=True))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every drawn document, decoded again."""
    return bpe.encode_digest(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_good),
    ("ngram_jaccard_join", drop_near_copies),
    ("personal_data", redact_personal_data),
    ("mixing_sources", mix_sources),
    ("bpe_codec", encode_texts),
]

#: Scores, spans and draws are not SQL; the tests compare the second stage with a plain version,
#: the first with its operator and the whole run's columns only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`.  A stage's table goes when the next one is written."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = f"{folder}/{k}-{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
