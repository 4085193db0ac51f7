"""Word count: one ``(word, 1)`` per token, summed.

Tokens are split on space/tab/newline/CR/form feed only, so case and punctuation are kept
(``We're`` is a word). The aggregate runs partial-then-final: every task collapses its tokens to one
row per distinct word before the shuffle (the combiner), so frequent words are not a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as tx


def word_count(df: DataFrame, text: str = "text", sort: bool = True) -> DataFrame:
    """``(word, count bigint)``; sorted by the word's UTF-8 bytes (capitals first) when ``sort``."""
    counts = (tx.explode_rows(df, tx.word_pieces(text), ("word",), [])
              .filter(F.col("word") != F.lit(""))
              .groupBy("word").agg(F.count(F.lit(1)).alias("count")))
    return counts.orderBy("word") if sort else counts
