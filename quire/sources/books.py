"""Book sources.

A book is one row ``(key, text)``. Plain-text files are read with ``wholetext`` so that a file
arrives as one row in file order: blank-line removal and re-joining are then a per-row expression,
with no shuffle and no order-unsafe ``collect_list``. (Limit: one book must fit in one row.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import metadata as md
from quire.functions import text as tx


def read_book_files(spark: SparkSession, directory: str, pattern: str = "*.txt") -> DataFrame:
    """All files matching ``{directory}/{pattern}`` (not recursive) as ``(file_name, text)``.

    ``file_name`` is the last path component as Spark reports it (percent-encoded, so ``a b.txt``
    becomes ``a%20b.txt``). Exactly-empty lines are dropped; files that then hold nothing vanish.
    """
    # (the argument, not .option(): text() would reset the option to its own default)
    raw = spark.read.text(f"{directory.rstrip('/')}/{pattern}", wholetext=True)
    return assemble_books(
        raw.select(md.file_name_from_path(F.col("_metadata.file_path")).alias("file_name"),
                   F.col("value").alias("text")),
        text="text",
    )


def assemble_books(books: DataFrame, text: str = "text") -> DataFrame:
    """Replace ``text`` by its non-empty lines joined with ``\\n``; drop books left empty.

    A book ends up empty exactly when its raw text holds nothing but ``\\r``/``\\n``, so the
    drop is decided on the raw text with a regex that stops at the first other character; the
    filter stays cheap wherever the optimizer pushes it.
    """
    return (books.filter(F.col(text).rlike(r"[^\r\n]"))
            .withColumn(text, tx.assemble_lines(text)))


def first_by_key(books: DataFrame, n: int, key: str) -> DataFrame:
    """The ``n`` rows with the smallest keys (null keys last), wide columns read for those only.

    A key-only scan finds the n-th smallest key and how many rows of that key belong to the first
    n (top-n taken map-side, one row back). Rows below the cutoff are selected with a literal
    filter, which reaches the Parquet scan and skips row groups; they keep their partitions and
    are not sorted. Only ties at the cutoff are settled, by the hash of the row.
    """
    if n <= 0:
        return books.limit(0)
    keys = books.select(F.col(key).alias("k")).orderBy(F.asc_nulls_last("k")).limit(n)
    counts = keys.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    last = counts.filter("k is not null").agg(F.max(F.struct("k", "n")).alias("top"), F.sum("n").alias("keyed")).first()
    found = last.keyed or 0
    tie = lambda rows, m: rows.orderBy(F.xxhash64(*books.columns)).limit(m)
    parts = []
    if found:
        parts = [books.where(F.col(key) < F.lit(last.top.k)), tie(books.where(F.col(key) == F.lit(last.top.k)), last.top.n)]
    if found < n:
        parts.append(tie(books.where(F.col(key).isNull()), n - found))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def subset(books: DataFrame, n: int | None, key: str = "file_name") -> DataFrame:
    """The first ``n`` books by key (all when ``n`` is None): a deterministic bounded load."""
    if n is None:
        return books
    return first_by_key(books, n, key)


def preview(books: DataFrame, n: int, key: str = "file_name") -> DataFrame:
    """First ``n`` rows by key, in that order (see :func:`first_by_key`): a handful, for reading."""
    return first_by_key(books, n, key).orderBy(F.asc_nulls_last(key))
