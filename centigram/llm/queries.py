"""Queries over the corpus tables, one per operator, and the SQL that some are checked against."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centigram.llm import bpe, chat, grammar, html, jaccard, merkle, mixing, negatives, neighbours, oracles, pii, ranking, rules, scoring

#: Folder of the public tokenizers' files; their module tells it where it can be imported.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
BYTE_BPE = "byte_bpe_50k.json"


def tokenizer_path(name: str = BYTE_BPE) -> str:
    try:
        import public_tokenizers
    except ImportError:
        return os.path.join(TOKENIZERS, name)
    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mixing_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.transform("draws", lambda d: d["shard"]).alias("shards"))


def lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score(table(spark, folder, "documents"))


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.detect(table(spark, folder, "documents"))


def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.link(table(spark, folder, "conversations"))


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_digest(table(spark, folder, "documents"), tokenizer_path())


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.groups(table(spark, folder, "documents"))


def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


def embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, folder, "embeddings"))


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    return grammar.digests(table(spark, folder, "documents"), tokenizer_path())


def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verified(table(spark, folder, "documents"))


def hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mine(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing_sources": mixing_sources,
    "op2_lm_scoring": lm_scoring,
    "op3_personal_data": personal_data,
    "op4_chat_formatting": chat_formatting,
    "op5_quality_rules": quality_rules,
    "op6_bpe_codec": bpe_codec,
    "op7_quality_classifier": quality_classifier,
    "op8_ngram_jaccard_join": ngram_jaccard_join,
    "op9_html_extraction": html_extraction,
    "op10_embedding_near_dedup": embedding_near_dedup,
    "op11_token_files": token_files,
    "op12_merkle_manifest": merkle_manifest,
    "op13_hard_negatives": hard_negatives,
}

#: Shingles, overlaps and reachable documents, as the contract states them.
JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS words
  FROM documents
), t AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i, len(words) AS n FROM w),
u AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, i, n, concat_ws(' ', word, lead(word, 1) OVER p, lead(word, 2) OVER p, lead(word, 3) OVER p, lead(word, 4) OVER p) AS shingle
    FROM t WINDOW p AS (PARTITION BY doc_id ORDER BY i)
  ) WHERE i <= greatest(n - 4, 1)
), s AS (SELECT d.doc_id, count(u.shingle) AS n FROM documents d LEFT JOIN u USING (doc_id) GROUP BY d.doc_id),
rare AS (SELECT shingle FROM u GROUP BY shingle HAVING count(*) > 1),
v AS (SELECT u.* FROM u SEMI JOIN rare USING (shingle)),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM v a JOIN v b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (
  SELECT o.a, o.b FROM o JOIN s x ON x.doc_id = o.a JOIN s y ON y.doc_id = o.b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, m.component_id
FROM s JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) m USING (doc_id)
"""

CHAT = r"""
SELECT conv_id, turn, role, turn AS place_turn, CAST(0 AS BIGINT) AS place_depth, CAST(0 AS BIGINT) AS n_calls,
  CAST(0 AS BIGINT) AS n_answered, CAST(0 AS BIGINT) AS n_invalid, false AS orphan, false AS cyclic,
  '{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || '}' AS json
FROM conversations
"""

ORACLES: dict[str, str] = {
    "op4_chat_formatting": CHAT,
    "op8_ngram_jaccard_join": JACCARD,
    "op12_merkle_manifest": oracles.manifest(),
    "op13_hard_negatives": oracles.HARD_NEGATIVES,
}
