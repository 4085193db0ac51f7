"""Text cleaning, splitting and line rules as Columns (all JVM built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import fixed_values as fv


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(text: str | Column = "text", letters: str = "ascii") -> Column:
    """Replace each run of non-letter, non-whitespace characters by one space, then lower-case.

    Non-ASCII letters count as non-letters (``café`` -> ``caf``), exactly like the original rule;
    ``letters="unicode"`` keeps the letters of every script.
    """
    patterns = {"ascii": fv.CLEAN_PATTERN_JAVA, "unicode": fv.CLEAN_PATTERN_UNICODE}
    return F.lower(F.regexp_replace(_col(text), patterns[letters], " "))


def tokens(clean: str | Column) -> Column:
    """``pyspark.ml.feature.Tokenizer`` semantics with built-in expressions (codegen, no UDF), for
    text that :func:`clean_text` has lower-cased.

    Split on *single* whitespace, drop trailing empty strings (Java ``split``):
    ``""`` gives ``[""]``, a whitespace-only text gives ``[]``, inner/leading empties are kept.
    """
    c = _col(clean)
    # a character trim is linear; an anchored \s+ rescans every inner run of white space
    trimmed = F.rtrim(c, F.lit(" \t\n\x0b\f\r"))
    return (F.when((trimmed == F.lit("")) & (c != F.lit("")), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, r"\s")))


def stop_word_set(stop_words=fv.ENGLISH_STOP_WORDS) -> list[str]:
    return sorted({w.lower() for w in stop_words})


def is_stop_word(token: Column, stop_words=fv.ENGLISH_STOP_WORDS) -> Column:
    """Membership in the stop-word list; the literal list becomes a hash-set test (INSET)."""
    return token.isin(stop_word_set(stop_words))


def without_stop_words(tokens_col: Column, stop_words=fv.ENGLISH_STOP_WORDS) -> Column:
    """Drop stop words from a token array (``StopWordsRemover``, case-insensitive, on lower-case
    tokens). Higher-order functions are interpreted, so where positions are not needed prefer
    exploding first and filtering with :func:`is_stop_word` (whole-stage codegen)."""
    return F.filter(tokens_col, lambda t: ~is_stop_word(t, stop_words))


def explode_rows(df, array_col: Column, names: tuple[str, ...], keep: list[str],
                 with_pos: bool = False):
    """Rows of ``array_col`` (empty or null arrays give none), like ``explode``/``posexplode``.

    Written as the ``_outer`` generator plus a filter on the generated position so that Catalyst
    does not infer ``size(array) > 0`` and push it below the generator: that inferred filter
    evaluates the whole array expression (tokenization, hashing) a second time per row.
    """
    pos = "_pos"
    gen = F.posexplode_outer(array_col).alias(pos, names[-1])
    out = df.select(*keep, gen).filter(F.col(pos).isNotNull())
    if with_pos:
        return out.withColumnRenamed(pos, names[0])
    return out.drop(pos)


def evaluate_once(df, columns: dict[str, Column], keep: list[str]):
    """Select ``keep`` plus ``columns``, computing each of ``columns`` exactly once per row.

    Spark evaluates a filter and the projection above it separately, so ``filter(regex(text) !=
    '')`` followed by ``select(regex(text))`` runs the regex twice, and the optimizer may push the
    filter below a repartition into the scan. Emitting the values through a one-element
    ``posexplode_outer`` makes them generated columns: later filters on them stay above the
    generator and read the computed values instead of recomputing them.
    """
    packed = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    rows = explode_rows(df, packed, ("_v",), keep)
    return rows.select(*keep, *[F.col("_v")[n].alias(n) for n in columns])


def word_pieces(text: str | Column = "text") -> Column:
    """Split on runs of space/tab/newline/CR/form feed. A leading or trailing delimiter leaves one
    empty piece, which word counting drops after exploding (a plain filter, not a lambda)."""
    return F.split(_col(text), fv.WORD_DELIMITERS)


def assemble_lines(text: str | Column = "text") -> Column:
    """Drop exactly-empty lines and re-join the rest with ``\\n`` (no trailing newline).

    Any of CRLF, LF and CR ends a line; whitespace-only lines are kept. Works on the whole text of
    one book held in one row, so line order is the file's order and no shuffle is needed.

    Every ``\\r`` or ``\\n`` belongs to some line ending, so a run of them is a run of line endings
    with only empty lines in between: replacing each run by one ``\\n`` and removing a leading and a
    trailing one gives exactly "split into lines, drop the empty ones, join with ``\\n``", in two
    codegen'd regex passes instead of an array and an interpreted lambda.
    """
    collapsed = F.regexp_replace(_col(text), r"[\r\n]+", "\n")
    return F.regexp_replace(collapsed, r"^\n|\n\z", "")


def inject_blank_lines(text: str | Column = "text") -> Column:
    """Test helper for line assembly: a blank line before the text and after every line."""
    nl = F.lit("\n")
    return F.concat(nl, F.replace(_col(text), nl, F.concat(nl, nl)))
