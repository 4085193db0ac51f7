"""Header metadata as Columns.

All extractors are ``regexp_extract`` over the whole text: JVM-side, per row, no shuffle. The raw
extract is ``""`` on no match; the ``nullable`` helpers turn that into null where the metadata
profile does so (title, author, language, encoding, year) while ``release_date`` stays ``""``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import fixed_values as fv


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_header(label: str, text: str | Column = "text") -> Column:
    """Value of a header line that begins with ``label:``, trimmed; ``""`` when there is none.

    Unlike the patterns of the default mode it never takes the next line's text for an empty value, does not
    match inside another label (``Original Title:``), and reads a last line without a newline.
    """
    return F.regexp_extract(_col(text), rf"(?m)^{label}:[ \t]*(\S.*?)[ \t]*$", 1)


def strict_release_date(text: str | Column = "text") -> Column:
    """:func:`strict_header` of the release date, cut at ``[``."""
    return F.trim(F.regexp_extract(_col(text), r"(?m)^Release Date:[ \t]*([^\[\r\n]*)", 1))


def raw_title(text: str | Column = "text") -> Column:
    return F.regexp_extract(_col(text), fv.TITLE_PATTERN, 1)


def raw_author(text: str | Column = "text") -> Column:
    return F.regexp_extract(_col(text), fv.AUTHOR_PATTERN, 1)


def release_date(text: str | Column = "text") -> Column:
    """Release date up to the line end or ``[``, untrimmed; ``""`` when absent."""
    return F.regexp_extract(_col(text), fv.RELEASE_DATE_PATTERN, 1)


def raw_language(text: str | Column = "text") -> Column:
    return F.regexp_extract(_col(text), fv.LANGUAGE_PATTERN, 1)


def raw_encoding(text: str | Column = "text") -> Column:
    return F.regexp_extract(_col(text), fv.ENCODING_PATTERN, 1)


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _year_or_null(year_str: Column) -> Column:
    # The captured group is four digits or empty, so the cast cannot fail; try_cast keeps the
    # expression safe under ANSI mode regardless.
    return empty_to_null(year_str).try_cast("int")


def year_from_date(date: str | Column) -> Column:
    """First four-digit run of an already extracted release date, else null."""
    return _year_or_null(F.regexp_extract(_col(date), fv.YEAR_IN_DATE_PATTERN, 1))


def year_from_line(text: str | Column = "text") -> Column:
    """First four-digit run after ``Release Date:`` on the same line of the text, else null.

    Differs from :func:`year_from_date` when the date has no year but the line has digits
    later on (``Release Date: June [EBook #2701]`` gives 2701 here, null there).
    """
    return _year_or_null(F.regexp_extract(_col(text), fv.YEAR_IN_LINE_PATTERN, 1))


def file_name_from_path(path: str | Column) -> Column:
    """Last path component ending in ``.txt`` (percent-encoding of the path is kept)."""
    return F.regexp_extract(_col(path), fv.FILE_NAME_PATTERN, 1)
