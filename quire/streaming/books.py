"""The per-book operators over a directory of book files that grows (Structured Streaming).

New ``*.txt`` files are picked up as they arrive, one row per file (``wholetext``), so line assembly
and header extraction stay stateless per row and run in append mode. Word counts are a running
aggregate kept in Spark's state store (complete or update mode). Both reuse the batch Column
functions; nothing here is specific to streaming except the source and the sink.

The caller starts the query with the sink and trigger of their choice, e.g.::

    q = (stream_metadata(spark, "/landing/books").writeStream.format("parquet")
         .option("checkpointLocation", ckpt).option("path", out).trigger(availableNow=True).start())
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import metadata as md
from quire.operators.metadata import extract_metadata
from quire.operators.wordcount import word_count
from quire.sources.books import assemble_books

BOOK_FILE_SCHEMA = "value string"


def stream_books(spark: SparkSession, directory: str, pattern: str = "*.txt",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(file_name, text)``: one row per new book file, blank lines removed."""
    reader = spark.readStream.schema(BOOK_FILE_SCHEMA).option("wholetext", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.text(f"{directory.rstrip('/')}/{pattern}", wholetext=True)
    return assemble_books(
        raw.select(md.file_name_from_path(F.col("_metadata.file_path")).alias("file_name"),
                   F.col("value").alias("text")))


def stream_metadata(spark: SparkSession, directory: str, **kw) -> DataFrame:
    """Streaming metadata rows (append mode), same columns as the batch extraction."""
    return extract_metadata(stream_books(spark, directory, **kw))


def stream_word_count(spark: SparkSession, directory: str, **kw) -> DataFrame:
    """Running ``(word, count)`` over all books seen so far (complete or update mode)."""
    books = stream_books(spark, directory, **kw)
    return word_count(books, "text", sort=False)
