"""Column-level building blocks: header regexes and text rules."""

from quire.functions.metadata import (
    empty_to_null, file_name_from_path, raw_author, raw_encoding, raw_language, raw_title,
    release_date, year_from_date, year_from_line,
)
from quire.functions.text import assemble_lines, clean_text, inject_blank_lines

__all__ = [
    "empty_to_null", "file_name_from_path", "raw_author", "raw_encoding", "raw_language",
    "raw_title", "release_date", "year_from_date", "year_from_line",
    "assemble_lines", "clean_text", "inject_blank_lines",
]
