"""Word count."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centigram.functions.columns import col


def _normalized(df: DataFrame, column: str) -> DataFrame:
    """Non-empty texts as ``text``, with \\n as the only line break."""
    text = F.translate(F.replace(col(column), F.lit("\r\n"), F.lit("\n")), "\r", "\n")
    return df.filter(col(column) != "").select(text.alias("text"))


def _without_last_break() -> Column:
    """A break at the very end closes the last line; it does not open another."""
    text = F.col("text")
    return F.when(text.endswith("\n"), F.left(text, F.length(text) - 1)).otherwise(text)


def text_lines(df: DataFrame, column: str = "value") -> DataFrame:
    """Multi-line text as one ``value`` per line, as a text file would be read."""
    lines = F.split(_without_last_break(), "\n")
    return _normalized(df, column).select(F.explode(lines).alias("value"))


def word_count(df: DataFrame, column: str = "value") -> DataFrame:
    """(word, count) over single-space tokens of every line; empty tokens are words too.

    Each row is one line, and an empty line is one empty token; put ``text_lines`` before it
    for whole documents.  Counting starts before the shuffle: a word that fills the corpus is
    one row per task.
    """
    tokens = df.select(F.explode(F.split(col(column), " ")).alias("word"))
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
