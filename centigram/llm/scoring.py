"""LM scoring: a log-bilinear model trained with noise-contrastive estimation.

Tokens are lower-cased words and one end per text.  The model predicts the state of the next
token from the state before it: frequent words are states of their own, the rest fall into
classes by their last two bytes.  A state's score is bilinear in two learned vectors plus a
bias.  Training minimises the NCE loss with its expectation over the noise taken exactly, over
the transition counts of *all* training tokens, which Spark sums; the table of counts has
STATES^2 cells whatever the input.  Scoring uses softmax rows, made by one batched matrix
product, so the probabilities of all words after a context sum to one: inside a class a word
has (c + 1) / (N + V + 1), N and V over the class, and one place is left for an unseen word.

Word counts cover the whole corpus and are never gathered: every block of documents asks for
the counts of its distinct words by a join, and gets back a dictionary as large as the block.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centigram.llm.common import cut, fold, prepare, raw, texts

WORDS = 768
CLASSES = 256
WIDTH = 32
NOISE = 16
STEPS = 160
#: Text bytes that one block of documents holds on average.
BLOCK_BYTES = 8 << 20
#: Distinct words that a task keeps before it passes their counts on.
HELD_WORDS = 400_000
#: The end of a text.  No word contains a line feed.
END = b"\n"


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


def state_of(word: bytes, known: dict[bytes, int]) -> int:
    k = known.get(word)
    return len(known) + class_of(word) if k is None else k


def word_counts(training: DataFrame) -> DataFrame:
    """(token, c) over all training texts; tasks add up their own words first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["token", "c"])
            held.clear()
            return out

        for batch in batches:
            for text in raw(batch.column("text")):
                held.update(tokens(text))
            if len(held) > HELD_WORDS:
                yield flush()
        yield flush()

    return training.select("text").mapInArrow(count, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def transitions(training: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """(a, b, n): how often state b follows state a; a text starts after the end state."""
    size = len(known) + CLASSES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(size * size, np.int64)
        cache: dict[bytes, int] = {}
        for batch in batches:
            for text in raw(batch.column("text")):
                row = []
                for w in tokens(text):
                    k = cache.get(w)
                    if k is None:
                        k = cache[w] = state_of(w, known)
                    row.append(k)
                b = np.array(row, np.int64)
                a = np.concatenate([b[-1:], b[:-1]])
                cell, n = np.unique(a * size + b, return_counts=True)
                cells[cell] += n
            if len(cache) > HELD_WORDS:
                cache.clear()
        used = np.flatnonzero(cells)
        yield pa.record_batch([pa.array(used // size, pa.int32()), pa.array(used % size, pa.int32()), pa.array(cells[used])], ["a", "b", "n"])

    return training.select("text").mapInArrow(count, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def train(counts: np.ndarray, width: int = WIDTH, noise: int = NOISE, steps: int = STEPS, seed: int = 1) -> np.ndarray:
    """Normalised log10 probabilities, a row per context, from a matrix of transition counts."""
    size = len(counts)
    total = counts.sum()
    if not total:
        return np.full((size, size), -np.log10(size))
    weight = counts / total
    from_a, p = weight.sum(axis=1), (counts.sum(axis=0) + 0.5) / (total + 0.5 * size)
    rng = np.random.default_rng(seed)
    shape = {"r": (size, width), "c": (width, width), "q": (size, width), "b": (size,)}
    theta = {k: rng.normal(0, 0.1, s).astype(np.float32) for k, s in shape.items()}
    theta["c"] = np.eye(width, dtype=np.float32)
    theta["b"] = np.log(p).astype(np.float32)
    first = {k: np.zeros(s, np.float32) for k, s in shape.items()}
    second = {k: np.zeros(s, np.float32) for k, s in shape.items()}
    shift = np.log(noise * p).astype(np.float32)
    against = (from_a[:, None] * (noise * p)[None, :]).astype(np.float32)
    weight = weight.astype(np.float32)
    for step in range(1, steps + 1):
        hidden = theta["r"] @ theta["c"]
        odds = hidden @ theta["q"].T + theta["b"] - shift
        data = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        g = (against * data - weight * (1 - data)) * size
        back = g @ theta["q"]
        slope = {"r": back @ theta["c"].T, "c": theta["r"].T @ back, "q": g.T @ hidden, "b": g.sum(axis=0)}
        rate = 0.05 * (1 - 0.9 * step / steps)
        for k in theta:
            first[k] = 0.9 * first[k] + 0.1 * slope[k]
            second[k] = 0.999 * second[k] + 0.001 * slope[k] ** 2
            theta[k] -= np.float32(rate / (1 - 0.9**step)) * first[k] / (np.sqrt(second[k] / np.float32(1 - 0.999**step)) + np.float32(1e-8))
    scores = (theta["r"] @ theta["c"] @ theta["q"].T + theta["b"]).astype(np.float64)
    scores -= scores.max(axis=1, keepdims=True)
    return (scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))) / np.log(10)


def fit(spark: SparkSession, training: DataFrame, counts: DataFrame) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    """Known words with their states, log10 transition rows, log10 of 1 / (N + V + 1) by class."""
    top = counts.where(F.col("token") != F.lit(END)).orderBy(F.desc("c"), "token").limit(WORDS).collect()
    known = {END: 0} | {bytes(r["token"]): k for k, r in enumerate(top, 1)}
    size = len(known) + CLASSES
    cells = transitions(training, known).toPandas()
    matrix = np.zeros((size, size))
    matrix[cells["a"], cells["b"]] = cells["n"]
    if cells.empty:
        matrix = np.zeros((size, size))
    ending = F.expr("pmod(crc32(substring(token, greatest(1, length(token) - 1), 2)), 256)")
    frequent = spark.createDataFrame([(bytearray(w),) for w in known], "token binary")
    rest = (
        counts.join(F.broadcast(frequent), "token", "left_anti")  # at most WORDS + 1 rows
        .groupBy(ending.cast("int").alias("k"))
        .agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"))
        .collect()
    )
    spread = np.zeros(CLASSES)
    for r in rest:
        spread[r["k"]] = r["n"] + r["v"]
    return known, train(matrix).astype(np.float32), -np.log10(spread + 1)


def score(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text.

    Documents whose crc32(doc_id) modulo 7 is 2 are held out; with none to learn from, base
    scores are 0 and the model is uniform.  A null text is an empty one and has one token, its
    end; repeated rows count and are scored each; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    every = texts(docs).withColumn("held_out", fold("doc_id", 7) == 2)
    training = every.where("NOT held_out")
    counts = cut(word_counts(training))
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    known, rows, spread = fit(spark, training, counts)
    model = spark.sparkContext.broadcast((known, rows, spread))  # (WORDS + CLASSES)^2 floats

    size = every.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    placed = every.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(blocks)))

    def distinct(key, table):
        found: set[bytes] = set()
        for text in raw(table.column("text").combine_chunks()):
            found.update(text.lower().split())
        found.add(END)
        return pa.table({"block": pa.array([key[0].as_py()] * len(found), pa.int64()), "token": pa.array(list(found), pa.binary())})

    def measure(key, left, right):
        known, rows, spread = model.value
        words = right.column("token").to_pylist()
        c = right.column("c").to_numpy(zero_copy_only=False)
        index = {w: k for k, w in enumerate(words)}
        state = np.array([state_of(w, known) for w in words], np.int64)
        log_c = np.log10(c + 1.0)
        inside = np.where(state >= len(known), log_c + spread[np.maximum(state - len(known), 0)], 0.0)
        less = np.log10(total + kinds + 1)
        out = []
        for text in raw(left.column("text").combine_chunks()):
            ids = np.array([index[w] for w in tokens(text)], np.int64)
            b = state[ids]
            a = np.concatenate([b[-1:], b[:-1]])
            model_score = float(rows[a, b].sum(dtype=np.float64) + inside[ids].sum())
            out.append((len(ids), int((c[ids] > 0).sum()), float(log_c[ids].sum() - len(ids) * less), model_score))
        n_tokens, n_known, base, own = zip(*out, strict=True) if out else ((),) * 4
        return pa.table(
            {
                "doc_id": left.column("doc_id"),
                "held_out": left.column("held_out"),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "train_tokens": pa.array([total] * len(out), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(own, pa.float64()),
            }
        )

    asked = placed.groupBy("block").applyInArrow(distinct, "block long, token binary")
    answers = asked.join(counts, "token", "left").select("block", "token", F.coalesce("c", F.lit(0)).alias("c"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        placed.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(measure, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    )
