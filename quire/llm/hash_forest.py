"""Operator 6: approximate nearest neighbours by a hash-prefix forest.

Each tree labels a vector with a long string of bits (signs of its projections on random
directions) and keeps the labels as one sorted array: the subtree of a prefix is a range of it. A
query descends in each tree to its longest prefix match, of whatever length, by binary search; then
all trees ascend together, one bit at a time, and the ranges of the shorter prefix are added, until
the candidates are enough. Candidates are ranked by cosine in double precision.

Rows are dealt to shards, each with a forest of its own, and queries go to all shards in blocks;
the best of the shards are merged for each query. How many candidates are enough is found in the
task: a sample of the queries is compared with the shard by brute force, and while its recall is
below ``AUDIT_RECALL`` the number doubles (at the size of the shard the search is exact). The
random directions are the same everywhere and need no fitting; every valid row is indexed.

Defined results: vectors that are null, zero or hold null or non-finite components take no part;
only vectors of the query's dimension are candidates; fewer candidates than asked for are all
returned; ties go to the smaller id; rows of one id count as one (the smallest of its vectors);
rows without an id take no part.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.vectors import is_valid, meet, packed, unit
from quire.session import materialize

TREES, BITS = 16, 64
K = 5
SHARDS, SHARD_ROWS = 8, 100_000
QUERY_ROWS = 1024
ENOUGH = 64  # candidates to begin with, doubled by the audit
AUDIT_ROWS, AUDIT_RECALL = 48, 0.96


def labels(x: np.ndarray) -> np.ndarray:
    """Bit strings of all vectors in each tree (TREES x rows), most significant bit first."""
    rng = np.random.default_rng(6)
    out = np.zeros((TREES, len(x)), np.uint64)
    for t in range(TREES):
        side = x @ rng.normal(size=(x.shape[1], BITS)) > 0
        out[t] = (side.astype(np.uint64) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)).sum(1, dtype=np.uint64)
    return out


class Forest:
    """Sorted label arrays of one shard."""

    def __init__(self, x: np.ndarray):
        self.x = x
        label = labels(x)
        self.order = np.argsort(label, axis=1, kind="stable")
        self.sorted = np.take_along_axis(label, self.order, 1)

    def ranges(self, asked: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of each query's prefix (length given for each query) in each tree."""
        mask = np.where(prefix == 0, np.uint64(0), ~np.uint64(0) << (np.uint64(BITS) - np.maximum(prefix, 1).astype(np.uint64)))
        low = np.stack([np.searchsorted(s, a & mask) for s, a in zip(self.sorted, asked)])
        high = np.stack([np.searchsorted(s, a | ~mask, side="right") for s, a in zip(self.sorted, asked)])
        return low, high

    def descend(self, asked: np.ndarray) -> np.ndarray:
        """Longest prefix that any label shares with the query, over all trees."""
        best = np.zeros(asked.shape[1], np.int64)
        for s, a in zip(self.sorted, asked):
            at = np.searchsorted(s, a)
            for side in (np.maximum(at - 1, 0), np.minimum(at, len(s) - 1)):
                differ = s[side] ^ a
                # length of the common prefix: bits above the highest differing one
                length = np.full(len(a), BITS)
                some = differ > 0
                length[some] = BITS - 1 - np.floor(np.log2(differ[some].astype(np.float64))).astype(int)
                best = np.maximum(best, np.clip(length, 0, BITS))
        return best

    def candidates(self, asked: np.ndarray, enough: int) -> list[np.ndarray]:
        """Rows met by each query when all trees have ascended together far enough."""
        prefix = self.descend(asked)
        low, high = self.ranges(asked, prefix)
        while True:
            short = ((high - low).sum(0) < enough) & (prefix > 0)
            if not short.any():
                break
            prefix[short] -= 1
            low[:, short], high[:, short] = self.ranges(asked[:, short], prefix[short])
        return [np.unique(np.concatenate([o[a:b] for o, a, b in zip(self.order, low[:, i], high[:, i])]))
                for i in range(asked.shape[1])]


def nearest(forest: Forest, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int):
    """``(query id, id, score)`` of the k nearest rows of the shard found for each query."""
    asked = labels(q)
    sample = np.unique(np.linspace(0, len(q) - 1, AUDIT_ROWS).astype(int))

    def best(i, rows):
        rows = rows[ids[rows] != q_ids[i]]
        score = forest.x[rows] @ q[i]
        if len(rows) > 4 * k:
            rows = rows[score >= np.partition(score, -k)[-k]]
            score = forest.x[rows] @ q[i]
        order = np.lexsort((ids[rows], -score))[:k]
        return rows[order], score[order]

    truth = {i: set(best(i, np.arange(len(ids)))[0].tolist()) for i in sample}
    enough = ENOUGH
    while enough < 2 * len(ids) * TREES:
        met = forest.candidates(asked[:, sample], enough)
        hits = sum(len(truth[i] & set(best(i, c)[0].tolist())) for i, c in zip(sample, met))
        if hits >= AUDIT_RECALL * sum(map(len, truth.values())):
            break
        enough *= 2
    for i, rows in enumerate(forest.candidates(asked, enough)):
        rows, score = best(i, rows)
        yield q_ids[i], ids[rows], score


def _pack(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, key: str = "vec_id",
                       vector: str = "embedding", k: int = K) -> DataFrame:
    """``(query_id, rank, key, score)``: the k rows of ``vectors`` nearest to each of ``queries``."""
    def one_row_an_id(df):
        return df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).filter(
            is_valid("v") & F.col("id").isNotNull()).groupBy("id").agg(F.min("v").alias("v")).withColumns(
            {"dim": F.size("v"), "w": F.lit(1)})

    data = materialize(one_row_an_id(vectors), "vectors")
    ask = materialize(one_row_an_id(queries), "queries")
    shards, blocks = max(SHARDS, -(-data.count() // SHARD_ROWS)), max(1, -(-ask.count() // QUERY_ROWS))
    data = data.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int"))
    ask = ask.withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(blocks)).cast("int"))

    def blob(ids, weights, x):
        return _pack(ids=ids, x=unit(x))

    def index(ids, weights, x):
        forest = Forest(unit(x))
        return _pack(ids=ids, x=forest.x, order=forest.order, sorted=forest.sorted)

    forests = materialize(packed(data, ["dim", "shard"], "id", "w", "v", index), "forests")
    asked = materialize(packed(ask, ["dim", "block"], "id", "w", "v", blob), "asked")
    schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            for query, shard in zip(batch.column(0), batch.column(1)):
                stored, q = np.load(io.BytesIO(shard.as_py())), np.load(io.BytesIO(query.as_py()))
                forest = Forest.__new__(Forest)
                forest.x, forest.order, forest.sorted = stored["x"], stored["order"], stored["sorted"]
                for qid, ids, score in nearest(forest, stored["ids"], q["x"], q["ids"], k):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(ids), qid, np.int64)), pa.array(ids), pa.array(score)], schema=schema)

    found = meet(forests, asked).select("query", "data").mapInArrow(run, "query_id long, id long, score double")
    # at most k rows of each shard for a query
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(key), "score")
