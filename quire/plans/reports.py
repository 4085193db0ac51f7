"""Tidy reports built from the aggregates: the summaries as DataFrames, not driver-side text.

``metadata_report`` -> ``(section, rank int, key, value double)``: the completeness statistics
(section ``stats``), the top languages and authors and the first years. ``similarity_summary`` has the same shape:
the configuration (books, features, target) and the ranked most similar books. ``network_summary``
-> ``(metric, value double)``. All are a handful of rows from one-row aggregates and top-k lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import fixed_values as fv
from quire.operators import metadata as mo
from quire.operators.topk import top_k

STATS_KEYS = ("total_books", "with_title", "with_author", "with_year", "with_language",
              "pct_title", "pct_author", "pct_year", "pct_language", "min_year", "max_year")


def _stats_rows(stats: DataFrame) -> DataFrame:
    pairs = ", ".join(f"{i}, '{k}', cast({k} as double)" for i, k in enumerate(STATS_KEYS, 1))
    return stats.select(
        F.lit("stats").alias("section"),
        F.expr(f"stack({len(STATS_KEYS)}, {pairs}) as (rank, key, value)"))


def _top_rows(counts: DataFrame, column: str, section: str, n: int) -> DataFrame:
    best = top_k(counts, n, [F.col("count").desc(), F.col(column)])
    return best.select(F.lit(section).alias("section"), F.col("rank").cast("int").alias("rank"),
                       F.col(column).cast("string").alias("key"),
                       F.col("count").cast("double").alias("value"))


def metadata_report(metadata: DataFrame, top: int = fv.REPORT_TOP,
                    top_authors: int = fv.TOP_AUTHORS_LIMIT,
                    first_years: int = fv.REPORT_YEARS) -> DataFrame:
    stats = _stats_rows(mo.completeness_stats(metadata)).select(
        "section", F.col("rank").cast("int").alias("rank"), "key", "value")
    langs = _top_rows(mo.value_counts(metadata, "language"), "language", "top_languages", top)
    authors = _top_rows(mo.value_counts(metadata, "author"), "author", "top_authors", top_authors)
    years = top_k(mo.value_counts(metadata, "year", order="key"), first_years, [F.col("year")]).select(
        F.lit("first_years").alias("section"), F.col("rank").cast("int").alias("rank"),
        F.col("year").cast("string").alias("key"), F.col("count").cast("double").alias("value"))
    return stats.unionByName(langs).unionByName(authors).unionByName(years)


def network_summary(author_years_df: DataFrame, degrees: DataFrame,
                    window: int = fv.TIME_WINDOW) -> DataFrame:
    """Books, authors, window, edges and the average degrees (null when there are no authors).

    Every edge adds one to an out-degree, so the edge count is the sum of out-degrees: the edge
    list (quadratic in authors at worst) is not computed just to be counted.
    """
    books = author_years_df.select(F.count(F.lit(1))).scalar()
    row = degrees.agg(
        F.count(F.lit(1)).cast("double").alias("authors"),
        F.coalesce(F.sum("out_degree"), F.lit(0)).cast("double").alias("edges"),
        F.round(F.avg("out_degree"), 6).alias("avg_out_degree"),
        F.round(F.avg("in_degree"), 6).alias("avg_in_degree"),
    ).select(books.cast("double").alias("books"), "authors",
             F.lit(float(window)).alias("time_window"), "edges",
             "avg_out_degree", "avg_in_degree")
    names = ("books", "authors", "time_window", "edges", "avg_out_degree", "avg_in_degree")
    pairs = ", ".join(f"'{n}', {n}" for n in names)
    return row.select(F.expr(f"stack({len(names)}, {pairs}) as (metric, value)"))


def similarity_summary(docs: DataFrame, top: DataFrame, target, num_features: int,
                       key: str = "doc_id") -> DataFrame:
    """Configuration rows (books compared, hash features, target) plus the ranked top list."""
    row = docs.agg(F.count(F.lit(1)).cast("double").alias("books")).select(
        "books", F.lit(float(num_features)).alias("features"),
        F.lit(str(target)).alias("target"), F.lit(None).cast("double").alias("none"))
    config = row.select(
        F.lit("config").alias("section"),
        F.expr("stack(3, 1, 'books', books, 2, 'features', features, 3, target, none)"
               " as (rank, key, value)"))
    config = config.select("section", F.col("rank").cast("int").alias("rank"), "key", "value")
    ranked = top.select(F.lit("top_similar").alias("section"), F.col("rank").cast("int"),
                        F.col(key).cast("string").alias("key"),
                        F.col("similarity").cast("double").alias("value"))
    return config.unionByName(ranked)
