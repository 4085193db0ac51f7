"""What the numbered operators share: row keys, hash folds, grouping inside Python tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.tables import read_table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def fold(key: str, modulo: int = 5) -> Column:
    """``crc32(key as text) mod modulo``; a null key counts as empty text (remainder 0)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulo


def row_hash(key: str, text: str) -> Column:
    """Identity of a row among rows of one key: a hash of its text.

    Rows equal in key and text are copies of one row and always get the same result, so the pair
    (key, row_hash) is a sound join key even where keys repeat or are null.
    """
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def give_back() -> None:
    """Returns freed memory to the system: a worker process is kept for later tasks, and what its allocators hold
    counts against its executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU library
        pass


def arrow_map(df: DataFrame, function: Callable, schema: str, size: int = 1_000_000) -> DataFrame:
    """``mapInArrow`` of a function on one record batch that returns a dict of columns.

    Batches are cut to about ``size`` bytes, so array passes over a batch of long texts stay small.
    """
    target = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, int(batch.num_rows * size / max(1, batch.nbytes)))
            for start in range(0, batch.num_rows, step):
                out = function(batch.slice(start, step))
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], f.type, from_pandas=False) for f in arrow],
                        schema=arrow)
        give_back()

    return df.mapInArrow(run, target)


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Contiguous groups of equal keys from a sorted stream of record batches.

    One pass over the partition: only the group being read is held, and a task with thousands of
    small groups does not pay a pandas conversion for each.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        codes = [c.dictionary_encode().indices.to_numpy(zero_copy_only=False)
                 if c.null_count == 0 else
                 c.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                 for c in columns]
        change = np.zeros(batch.num_rows, bool)
        for code in codes:
            change[1:] |= code[1:] != code[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:]):
            if end == start:
                continue
            key = tuple(c[start].as_py() for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def texts_of(column) -> list[str]:
    """Python strings of an Arrow column, null as empty."""
    return [t if t is not None else "" for t in column.to_pylist()]


_BYTE_KEYS = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values (a multiply and shift finaliser)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and the word range of each (one offset more).

    Words are runs between ASCII white space, hashed as polynomials over their bytes: the whole
    batch takes a few array passes, with no Python step per word.
    """
    parts = [(t.lower() if lower else t).encode("utf-8", "surrogatepass") + b" " for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    inside = ~_SPACE[data]
    begin = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    at = np.flatnonzero(inside)
    word = np.cumsum(np.concatenate([[False], np.diff(at) > 1]))
    place = at - begin[word]
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(place.max()), _BASE)]), dtype=np.uint64)
    value = _BYTE_KEYS[data[at]] * powers[place]
    first = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
    hashes = mix64(np.add.reduceat(value, first))
    return hashes, np.concatenate([[0], np.searchsorted(begin, ends)])


def shingle_sets(texts: list[str], words: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text.

    A text of fewer words than a shingle has one shingle of all its words, a text without words
    none.
    """
    out: list[np.ndarray] = []
    start = 0
    while start < len(texts):  # about a megabyte at a time
        end, size = start + 1, len(texts[start])
        while end < len(texts) and size + len(texts[end]) <= 1_000_000:
            size, end = size + len(texts[end]), end + 1
        out += _shingle_sets(texts[start:end], words)
        start = end
    return out


def _shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    hashes, offset = word_hashes(texts)
    out = []
    total = len(hashes)
    rolled = np.zeros(max(0, total - words + 1), np.uint64)
    for k in range(words):
        rolled += mix64(hashes[k:total - words + 1 + k] + np.uint64(k + 1)) if total >= words else 0
    rolled = mix64(rolled)
    for i in range(len(texts)):
        a, b = int(offset[i]), int(offset[i + 1])
        if b - a >= words:
            out.append(np.unique(rolled[a:b - words + 1]))
        elif b > a:
            few = mix64(hashes[a:b] + np.arange(1, b - a + 1, dtype=np.uint64)).sum(dtype=np.uint64)
            out.append(mix64(np.array([few + np.uint64(b - a)])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of 64-bit hashes (column ``h``): the bits named by their first and by their last ``bits`` (at most
    32) are set. At most ``2 ** bits / 64`` numbers reach the driver."""
    at = F.expr(f"explode(array(shiftrightunsigned(h, {64 - bits}), h & {2 ** bits - 1}L))").alias("at")
    words = keys.select(at).groupBy(F.expr("shiftright(at, 6)").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("w"))
    table = words.toArrow()
    out = np.zeros(max(1, (1 << bits) >> 6), np.uint64)
    if table.num_rows:
        out[table.column("at").to_numpy()] = table.column("w").to_numpy().view(np.uint64)
    return out


def in_bitmap(marked: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    """Whether both bits of each key are set: true for every key of the bitmap and, by chance, for some others."""
    def bit(at):
        return (marked[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
    out = bit(keys >> np.uint64(64 - bits)) == 1
    first = np.flatnonzero(out)
    out[first] = bit(keys[first] & np.uint64(2 ** bits - 1)) == 1
    return out
