"""Declared output schemas: the contract of every registered query (names and types, in order).

``struct`` turns an entry into a ``StructType``; ``check`` asserts a DataFrame against it (types
compared by their SQL names, nullability not part of the contract).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

BOOKS = "doc_id bigint, text string"

QUERY_SCHEMAS: dict[str, str] = {
    "assemble_lines": BOOKS,
    "preview_books": BOOKS,
    "subset_documents": BOOKS,
    "extract_metadata": ("doc_id bigint, title string, author string, year int, language string, "
                         "encoding string, release_date string"),
    "preview_metadata": ("doc_id bigint, title string, author string, year int, language string, "
                         "encoding string, release_date string"),
    "metadata_stats": ("total_books bigint, with_title bigint, with_author bigint, "
                       "with_year bigint, with_language bigint, pct_title double, "
                       "pct_author double, pct_year double, pct_language double, "
                       "min_year int, max_year int"),
    "books_per_year": "year int, count bigint",
    "language_distribution": "language string, count bigint",
    "encoding_distribution": "encoding string, count bigint",
    "top_authors": "author string, count bigint",
    "metadata_report": "section string, rank int, key string, value double",
    "word_count": "word string, count bigint",
    "author_years": "doc_id bigint, author string, year int",
    "influence_edges": "influencer string, influenced string",
    "author_degrees": "author string, in_degree bigint, out_degree bigint",
    "top_influential": "author string, in_degree bigint, out_degree bigint, rank int",
    "top_influenced": "author string, in_degree bigint, out_degree bigint, rank int",
    "network_summary": "metric string, value double",
    "clean_text": "doc_id bigint, clean_text string",
    "tokenize": "doc_id bigint, pos int, token string",
    "tfidf_terms": "doc_id bigint, term string, tf bigint, idf double, tfidf double",
    "similar_documents": "doc_id bigint, similarity double",
    "similar_documents_topk": "doc_id bigint, similarity double, rank int",
    "tfidf_hashed": "doc_id bigint, bucket int, weight double",
    "similar_documents_hashed": "doc_id bigint, similarity double",
    "similarity_summary": "section string, rank int, key string, value double",
    "most_similar_documents": "doc_id bigint, similar_doc_id bigint, similarity double, rank int",
    "similar_documents_lsh": "doc_id bigint, similar_doc_id bigint, similarity double, rank int",
    "similarity_product": "doc_id bigint, similar_doc_id bigint, similarity double, rank int",
    "author_pagerank": "author string, pagerank double",
    "author_triangles": "author string, neighbours bigint, triangles bigint, clustering double",
    "author_components": "author string, component string, size bigint",
    "author_cores": "author string, core bigint",
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def fields(ddl: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in struct(ddl).fields]


def check(df: DataFrame, ddl: str) -> DataFrame:
    """Return ``df`` unchanged if its columns and types are exactly ``ddl``; raise otherwise."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = fields(ddl)
    if got != want:
        raise ValueError(f"schema mismatch: got {got}, declared {want}")
    return df
