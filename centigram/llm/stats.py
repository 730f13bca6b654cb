"""Statistics of whole texts, one row per document, for the quality operators."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centigram.llm.common import batch_of, prepare, raw

#: Fixed values of the contract.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = (
    "log_words",
    "mean_word",
    "symbol_rate",
    "dup_line_rate",
    "repeat_rate",
    "distinct_rate",
    "top_word_rate",
    "same_next_rate",
    "upper_rate",
    "digit_rate",
    "shout_rate",
    "bar_rate",
    "stop_rate",
    "comma_rate",
    "line_words",
)
#: Bytes counted for the ratios.
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
BITS = 21


def counted(text: bytes, among: bytes) -> int:
    return len(text) - len(text.translate(None, among))


def repeated(words: list[bytes], width: int = 3) -> tuple[int, int, int, int]:
    """(words in windows found twice or more, distinct words, most of one word, equal neighbours)."""
    n = len(words)
    if not n:
        return 0, 0, 0, 0
    ids: dict[bytes, int] = {}
    row = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    most = int(np.bincount(row).max())
    same = int(np.count_nonzero(row[1:] == row[:-1]))
    if n < width:
        return 0, len(ids), most, same
    if len(ids) >> BITS:  # too many words for one packed integer: number the pairs first
        _, pair = np.unique(row[:-1] * np.int64(len(ids)) + row[1:], return_inverse=True)
        _, window = np.unique(pair[:-1] * np.int64(len(ids)) + row[2:], return_inverse=True)
    else:
        window = (row[:-2] << 2 * BITS) | (row[1:-1] << BITS) | row[2:]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    equal = ranked[1:] == ranked[:-1]
    again = np.zeros(len(window), bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    covered = np.zeros(n, bool)
    for k in range(width):
        covered[k : k + len(window)] |= again
    return int(covered.sum()), len(ids), most, same


def describe(text: bytes) -> tuple:
    """COUNTS and then RATIOS of one text; every ratio of an empty text is 0."""
    words = text.split()
    n = len(words)
    points = len(text) - counted(text, bytes(range(0x80, 0xC0)))
    word_chars = points - counted(text, SPACES)
    n_symbols = counted(text, SYMBOLS)
    seen: set[bytes] = set()
    lines = dup = 0
    for line in text.split(b"\n"):
        if line.strip(SPACES):
            lines += 1
            dup += line in seen
            seen.add(line)
    in_repeats, distinct, most, same = repeated(words)
    counts = (n, word_chars, n_symbols, dup, in_repeats)
    if not n:
        return counts + (0.0,) * len(RATIOS)
    upper, lower = counted(text, UPPER), counted(text, LOWER)
    return counts + (
        math.log1p(n),
        word_chars / n,
        n_symbols / n,
        dup / max(1, lines),
        in_repeats / n,
        distinct / n,
        most / n,
        same / n,
        upper / max(1, upper + lower),
        counted(text, DIGITS) / max(1, word_chars),
        text.count(b"!") / n,
        text.count(b"|") / n,
        text.count(b".") / n,
        text.count(b",") / n,
        math.log1p(n / max(1, lines)),
    )


def text_stats(docs: DataFrame, passed: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The passed columns, COUNTS (long) and RATIOS (double) of every whole text.

    Null counts as empty.
    """
    prepare(docs.sparkSession)
    kept = docs.select(*(F.col(f"`{c}`") for c in passed), F.coalesce("text", F.lit("")).alias("__text"))
    columns = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in passed]
    columns += [f"`__{c}` long" for c in COUNTS] + [f"`__{c}` double" for c in RATIOS]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [describe(t) for t in raw(batch.column("__text"))]
            values = [*zip(*rows, strict=True)] if rows else [()] * len(COUNTS + RATIOS)
            fields = {c: batch.column(c) for c in passed} | {f"__{c}": v for c, v in zip(COUNTS + RATIOS, values, strict=True)}
            schema = pa.schema(
                [pa.field(c, batch.column(c).type) for c in passed]
                + [pa.field(f"__{c}", pa.int64()) for c in COUNTS]
                + [pa.field(f"__{c}", pa.float64()) for c in RATIOS]
            )
            yield batch_of(fields, schema)

    return kept.mapInArrow(measure, ", ".join(columns))


def named(stats: DataFrame) -> DataFrame:
    """doc_id and the statistics under their plain names."""
    return stats.select("doc_id", *(F.col(f"__{c}").alias(c) for c in COUNTS + RATIOS))
