"""Vector rows as the two vector operators read them: valid rows, shards, and blocks of queries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import give_back, sorted_groups


def is_valid(column: str):
    """Not null, not empty, not zero, and every component a finite number."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(column, lambda x: x != 0), F.lit(False))


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths, as float64."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one (scaled by their largest component first, against overflow)."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def packed(rows: DataFrame, keys: list[str], ident: str, weight: str, vector: str, build) -> DataFrame:
    """One row for each group of ``keys``: what ``build(ids, weights, matrix)`` makes of it.

    ``build`` returns bytes. Groups are bounded by the caller (shards, blocks of queries).
    """
    schema = ", ".join([f"{k} int" for k in keys] + ["blob binary"])
    arrow = pa.schema([(k, pa.int32()) for k in keys] + [("blob", pa.binary())])

    def run(batches):
        for table in sorted_groups(batches, keys):
            blob = build(table.column(ident).to_numpy(), table.column(weight).to_numpy(),
                         matrix(table.column(vector)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([table.column(k)[0].as_py()], pa.int32()) for k in keys]
                + [pa.array([blob], pa.binary())], schema=arrow)

    return rows.select(*keys, ident, weight, vector).repartition(*keys).sortWithinPartitions(
        *keys, ident).mapInArrow(run, schema)


def in_pieces(rows: DataFrame, keys: list[str], ident: str, weight: str, vector: str, build, piece: int) -> DataFrame:
    """``(keys, part, blob)``: what ``build(ids, weights, matrix)`` makes of each group, cut into rows of at most
    ``piece`` bytes. The matrix has the numbers as they are stored."""
    arrow = pa.schema([(k, pa.int32()) for k in keys] + [("part", pa.int32()), ("blob", pa.binary())])

    def run(batches):
        for table in sorted_groups(batches, keys):
            names = [table.column(k)[0].as_py() for k in keys]
            column = table.column(vector).combine_chunks()
            blob = build(table.column(ident).to_numpy(), table.column(weight).to_numpy(),
                         column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))
            for part, at in enumerate(range(0, len(blob), piece)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], pa.int32()) for x in [*names, part]] + [pa.array([blob[at:at + piece]], pa.binary())], schema=arrow)
        give_back()

    return rows.select(*keys, ident, weight, vector).repartition(*keys).sortWithinPartitions(
        *keys, ident).mapInArrow(run, ", ".join(f"{k} int" for k in keys) + ", part int, blob binary")


def meet(shards: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every block of queries with every shard of its dimension: ``(dim, shard, block, query, data)``.

    An equi-join on (dim, shard, block): a shard's row is repeated for the blocks that ask it, so
    each pair is a row of its own and no task holds more than it reads.
    """
    ask = blocks.select("dim", "block", F.col("blob").alias("query"))
    data = shards.select("dim", "shard", F.col("blob").alias("data"))
    pairs = data.select("dim", "shard").join(ask.select("dim", "block"), "dim")
    return pairs.join(data, ["dim", "shard"]).repartition("dim", "shard", "block").join(
        ask, ["dim", "block"])
