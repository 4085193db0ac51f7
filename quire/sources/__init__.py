"""Sources and sinks: book files, driver tables, headed view, deterministic subsets, writers."""

from quire.sources.books import assemble_books, preview, read_book_files, subset
from quire.sources.sinks import write_csv, write_parquet
from quire.sources.tables import documents, headed_documents, headed_text_sql, read_table

__all__ = [
    "assemble_books", "preview", "read_book_files", "subset",
    "write_csv", "write_parquet",
    "documents", "headed_documents", "headed_text_sql", "read_table",
]
