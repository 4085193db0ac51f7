"""Streaming forms of the per-book operators (new book files arriving in a directory)."""

from quire.streaming.books import stream_books, stream_metadata, stream_word_count

__all__ = ["stream_books", "stream_metadata", "stream_word_count"]
