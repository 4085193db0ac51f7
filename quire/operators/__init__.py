"""DataFrame -> DataFrame operators."""

from quire.operators.influence import (
    author_degrees, author_years, influence_edges, top_influenced, top_influential,
)
from quire.operators.metadata import (
    books_per_year, completeness_stats, encoding_distribution, extract_metadata,
    language_distribution, top_authors, value_counts,
)
from quire.operators.similarity import cosine_to_target, top_similar
from quire.operators.terms import ml_tokenize, positioned_tokens, term_frequencies, tokenize
from quire.operators.tfidf import (
    hashed_cells, hashed_term_counts, tfidf_hashed, tfidf_terms, tfidf_vectors,
)
from quire.operators.topk import top_k
from quire.operators.wordcount import word_count

__all__ = [
    "author_degrees", "author_years", "influence_edges", "top_influenced", "top_influential",
    "books_per_year", "completeness_stats", "encoding_distribution", "extract_metadata",
    "language_distribution", "top_authors", "value_counts",
    "cosine_to_target", "top_similar",
    "ml_tokenize", "positioned_tokens", "term_frequencies", "tokenize",
    "hashed_cells", "hashed_term_counts", "tfidf_hashed", "tfidf_terms", "tfidf_vectors",
    "top_k", "word_count",
]
