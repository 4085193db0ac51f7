"""Header metadata extraction and completeness profiling.

Extraction is a single projection of regex Columns over each book: narrow, no shuffle. Profiles are
plain aggregations whose partial (map-side) step collapses each partition to one row per key
before the shuffle, so a language or author holding a third of all books costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import fixed_values as fv
from quire.functions import metadata as md
from quire.functions import text as tx

METADATA_COLUMNS = ("title", "author", "year", "language", "encoding", "release_date")


def extract_metadata(books: DataFrame, key: str = "file_name", text: str = "text", strict: bool = False) -> DataFrame:
    """``(key, title, author, year int, language, encoding, release_date)`` per book.

    Missing title/author/language/encoding/year are null; a missing release date is ``""``.
    The year is the first four digits of the extracted release date. ``strict`` reads header lines one by
    one (:func:`quire.functions.metadata.strict_header`) instead of keeping the quirks of the patterns.
    """
    if strict:
        date = md.strict_release_date(text)
        value = lambda label: md.empty_to_null(md.strict_header(label, text))
        return books.select(
            F.col(key), value("Title").alias("title"), value("Author").alias("author"),
            md.year_from_date(date).alias("year"), value("Language").alias("language"),
            value("Character set encoding").alias("encoding"), date.alias("release_date"))
    date = md.release_date(text)
    # a plain projection, so a profile that reads one column computes only that regex
    return books.select(
        F.col(key),
        md.empty_to_null(md.raw_title(text)).alias("title"),
        md.empty_to_null(md.raw_author(text)).alias("author"),
        md.year_from_date(date).alias("year"),
        md.empty_to_null(md.raw_language(text)).alias("language"),
        md.empty_to_null(md.raw_encoding(text)).alias("encoding"),
        date.alias("release_date"),
    )


def _pct(part, total):
    # null instead of a division error on an empty table
    return F.round(F.lit(100.0) * part / F.nullif(total, F.lit(0)), 4)


def completeness_stats(metadata: DataFrame) -> DataFrame:
    """One row: book count, non-null counts of title/author/year/language, their percentages and
    the year range. (Encoding is not part of the completeness profile.)"""
    total = F.count(F.lit(1))
    counted = {c: F.count(F.col(c)) for c in ("title", "author", "year", "language")}
    return metadata.agg(
        total.alias("total_books"),
        *[v.alias(f"with_{c}") for c, v in counted.items()],
        *[_pct(v, total).alias(f"pct_{c}") for c, v in counted.items()],
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
    )


def value_counts(metadata: DataFrame, column: str, order: str = "count") -> DataFrame:
    """``(column, count)`` over non-null values.

    ``order="count"`` sorts by count descending, then value ascending (a total order, so ties are
    deterministic); ``order="key"`` sorts by value ascending.
    """
    # the value passes a once-barrier before the non-null filter, so its regex is not evaluated
    # twice (filter and projection) nor pushed into the scan below a repartition
    values = tx.evaluate_once(metadata, {column: F.col(column)}, [])
    counts = (values.filter(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias("count")))
    if order == "key":
        return counts.orderBy(F.col(column))
    return counts.orderBy(F.col("count").desc(), F.col(column))


def books_per_year(metadata: DataFrame) -> DataFrame:
    return value_counts(metadata, "year", order="key")


def language_distribution(metadata: DataFrame) -> DataFrame:
    return value_counts(metadata, "language")


def encoding_distribution(metadata: DataFrame) -> DataFrame:
    return value_counts(metadata, "encoding")


def top_authors(metadata: DataFrame, limit: int = fv.TOP_AUTHORS_LIMIT) -> DataFrame:
    """The ``limit`` authors with most books; ties broken by author name."""
    return value_counts(metadata, "author").limit(limit)
