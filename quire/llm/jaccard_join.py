"""Operator 9: n-gram Jaccard join with Bayesian candidate pruning.

Texts with one set of word shingles form a class; classes are joined. A class has a MinHash
signature of ``HASHES`` values. Bands of it put classes that may be similar into common buckets. Two
classes of a bucket are compared by their MinHash values, ``STEP`` at a time: with a uniform prior
the posterior probability of a similarity of at least the threshold, given m matches in n, is
P(Bin(n + 1, threshold) <= m), and a pair for which it falls below ``TOLERANCE`` is dropped. The
rest is verified exactly, on whole shingle sets.

Pairs never become rows. A task holds two blocks of a bucket (or of a candidate component) and
returns for each class its number of links and a root in a spanning forest of the links found, so
rows grow with the classes, not with the pairs, and no group is ever held whole. Verification
takes all pairs of a candidate component, hence also links that every band missed between texts
joined through a third one. With 25 bands of 5 a pair at exactly 0.8 shares no bucket with
probability 5e-5, and the four looks of the pruning drop it with probability 4.2e-4; verification
brings such a link back only where both texts are joined through others.

Result per row: ``class_id`` (smallest key of the component of links: the near-duplicate class),
``copy_id`` (smallest key of rows with the same shingles), ``n_links`` (other rows linked directly:
copies and rows of linked classes), ``kept`` (the one row of its class that stays; rows equal in
key and text are one).

Defined results: null and empty texts have no shingles and link with nothing (``class_id`` is the
own key); one to four words are one shingle; equal rows get equal results; null keys sort first
among a class's keys as ids only if no other key is there.
"""

from __future__ import annotations

from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, mix64, row_hash, shingle_sets, sorted_groups, texts_of
from quire.llm.components import block_pairs, connected_components
from quire.session import materialize

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 25, 5
HASHES = 128
STEP, TOLERANCE = 32, 1e-4
BLOCK = 512  # classes of a block; a task holds two blocks

_RNG = np.random.default_rng(9)
_MULTIPLIER = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_SHIFT = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash signatures (sets x HASHES); of an empty set: the largest value everywhere."""
    out = np.full((len(sets), HASHES), 2**32 - 1, np.uint32)
    filled = [i for i, s in enumerate(sets) if len(s)]
    if filled:
        values = np.concatenate([sets[i] for i in filled])
        values = (values >> np.uint64(32)).astype(np.uint32)
        first = np.concatenate([[0], np.cumsum([len(sets[i]) for i in filled])[:-1]])
        for k in range(HASHES):
            out[filled, k] = np.minimum.reduceat(values * _MULTIPLIER[k] + _SHIFT[k], first)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key a band (signatures x BANDS)."""
    used = signature[:, :BANDS * ROWS].reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), used.shape[:2])
    for r in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + used[:, :, r])
    return key.view(np.int64)


def least_matches(threshold: float, tolerance: float, step: int, hashes: int) -> list[tuple[int, int]]:
    """``(n, m)``: after n values a pair needs m matches to stay."""
    out = []
    for n in range(step, hashes + 1, step):
        below, m = 0.0, 0
        while below + comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m) < tolerance:
            below += comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
            m += 1
        out.append((n, m))
    return out


class Forest:
    """Union of array rows: every row's root, kept as one label array."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: int, others: np.ndarray) -> None:
        roots = np.unique(self.root[np.append(others, i)])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]


def likely_pairs(signature: np.ndarray, split: int | None, rule) -> Forest:
    """Forest of the pairs that Bayesian pruning leaves. split: rows before it meet those after."""
    n = len(signature)
    forest = Forest(n)
    for i in range(n - 1 if split is None else split):
        others = np.arange(i + 1 if split is None else split, n)
        matches = np.zeros(len(others), np.int64)
        start = 0
        for upto, least in rule:
            matches += (signature[others, start:upto] == signature[i, start:upto]).sum(1)
            stay = matches >= least
            if not stay.all():
                others, matches = others[stay], matches[stay]
            if not len(others):
                break
            start = upto
        if len(others):
            forest.join(i, others)
    return forest


def exact_links(sets: list[np.ndarray], weight: np.ndarray, split: int | None, threshold: Fraction):
    """Links of each set by exact Jaccard similarity (weights of partners summed), and their forest."""
    n = len(sets)
    links, forest = np.zeros(n, np.int64), Forest(n)
    size = np.array([len(s) for s in sets])
    code = np.unique(np.concatenate(sets), return_inverse=True)[1]
    first = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(int(code.max()) + 1, np.int32)
    up, down = threshold.numerator, threshold.denominator
    for i in range(n - 1 if split is None else split):
        low = i + 1 if split is None else split
        mark[code[first[i]:first[i + 1]]] = 1
        common = np.add.reduceat(mark[code[first[low]:]], first[low:-1] - first[low])
        mark[code[first[i]:first[i + 1]]] = 0
        found = low + np.flatnonzero(common * (down + up) >= up * (size[i] + size[low:]))
        if len(found):
            links[i] += weight[found].sum()
            links[found] += weight[i]
            forest.join(i, found)
    return links, forest


def _in_block_pairs(dealt: DataFrame, group: list[str], schema: str, work) -> DataFrame:
    """Runs ``work(table, split)`` on every pair of blocks; it returns columns of the result."""
    keys = [*group, "bi", "bj"]
    arrow = pa.schema([("rid", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(batches):
        for table in sorted_groups(batches, keys):
            if table.num_rows < 2:
                continue
            rid = table.column("rid").to_numpy()
            own = table.column("own").to_numpy()
            crossing = table.column("bi")[0].as_py() != table.column("bj")[0].as_py()
            split = int((own == own[0]).sum()) if crossing else None
            if crossing and split == len(own):
                continue
            links, forest = work(table, split)
            root = rid[forest.root]
            yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(links), pa.array(root)], schema=arrow)

    return dealt.repartition(*keys).sortWithinPartitions(*keys, "own", "rid").mapInArrow(run, schema)


def describe(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``(key, rh, rid, sig)``: class (hash of the shingle set; null without shingles) and signature."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batch):
        sets = shingle_sets(texts_of(batch.column(2)), words)
        sig = signatures(sets)
        rid = [int(mix64(s * np.uint64(3) + np.arange(len(s), dtype=np.uint64)).sum(dtype=np.uint64)
                   .astype(np.int64)) if len(s) else None for s in sets]
        return {"key": batch.column(0), "rh": batch.column(1), "rid": rid,
                "sig": [s.tobytes() if r is not None else None for s, r in zip(sig, rid)]}

    return arrow_map(docs.select(F.col(key).alias("key"), row_hash(key, text).alias("rh"),
                                 F.col(text).alias("text")), run,
                     f"key {kind}, rh long, rid long, sig binary")


def near_duplicate_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                           threshold: float = THRESHOLD) -> DataFrame:
    """``(key, rh, class_id, copy_id, n_links, kept)`` for every row (rh: hash of its text)."""
    exact = Fraction(str(threshold))
    rule = least_matches(threshold, TOLERANCE, STEP, HASHES)
    rows = materialize(describe(docs, key, text, words), "rows")
    with_rid = rows.filter("rid is not null")
    classes = materialize(with_rid.groupBy("rid").agg(
        F.count(F.lit(1)).alias("w"), F.min("key").alias("low"),
        F.min(F.struct("key", "rh")).alias("first"), F.any_value("sig").alias("sig")), "classes")

    # candidates: buckets of at least two classes, pruned inside blocks of each bucket
    def keys(batch):
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, HASHES)
        return {"rid": batch.column(0), "buckets": list(band_keys(sig))}

    banded = arrow_map(classes.select("rid", "sig"), keys, "rid long, buckets array<long>").select(
        "rid", F.explode("buckets").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    members = materialize(banded.join(shared, "bucket"), "members")
    dealt = block_pairs(members, ["bucket"], "rid", "m", BLOCK).join(classes.select("rid", "sig"), "rid")

    def prune(table, split):
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(-1, HASHES)
        return np.zeros(len(sig), np.int64), likely_pairs(sig, split, rule)

    likely = _in_block_pairs(dealt, ["bucket"], "rid long, links long, root long", prune).filter("rid <> root")
    candidate = materialize(connected_components(likely, "rid", "root"), "candidates")

    # exact verification of all pairs of a candidate component, block by block
    sizes = candidate.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    chosen = classes.select(F.col("rid").alias("node"), "w", "first").join(
        candidate.join(sizes, "component"), "node").select(
        F.col("node").alias("rid"), "w", "component", "m",
        F.col("first.key").alias("key"), F.col("first.rh").alias("rh"))
    texts = docs.select(F.col(key).alias("k"), row_hash(key, text).alias("h"), F.col(text).alias("text"))
    with_text = chosen.join(texts, F.col("key").eqNullSafe(F.col("k")) & (F.col("rh") == F.col("h"))).drop(
        "k", "h").dropDuplicates(["rid"])
    dealt = block_pairs(with_text, ["component"], "rid", "m", BLOCK)

    def verify(table, split):
        sets = shingle_sets(texts_of(table.column("text")), words)
        return exact_links(sets, table.column("w").to_numpy(), split, exact)

    verified = materialize(_in_block_pairs(
        dealt.drop("m", "key", "rh"), ["component"], "rid long, links long, root long", verify), "verified")
    links = verified.groupBy("rid").agg(F.sum("links").alias("links"))
    groups = connected_components(verified.filter("rid <> root"), "rid", "root").select(
        F.col("node").alias("rid"), "component")

    # one row a class, then one a row of the input
    found = classes.drop("sig").join(links, "rid", "left").join(groups, "rid", "left").select(
        "rid", "w", "low", "first", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("component", "rid").alias("component"))
    lead = found.groupBy("component").agg(F.min("low").alias("class_id"), F.min("first").alias("lead"))
    table = found.join(lead, "component").select(
        F.col("rid").alias("__rid"), F.col("low").alias("copy_id"), "class_id", "lead",
        (F.col("links") + F.col("w") - 1).alias("n_links"))
    return rows.join(table, F.col("rid") == F.col("__rid"), "left").select(
        "key", "rh",
        F.when(F.col("__rid").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("__rid").isNull(), F.col("key")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("__rid").isNull() | (F.col("lead.key").eqNullSafe(F.col("key"))
                                    & (F.col("lead.rh") == F.col("rh")))).alias("kept"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                         threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each near-duplicate class, its columns unchanged."""
    kept = near_duplicate_classes(docs, key, text, words, threshold).filter("kept").select(
        F.col("key").alias("__k"), F.col("rh").alias("__h")).distinct()
    rows = docs.withColumn("__rh", row_hash(key, text))
    joined = rows.join(kept, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__rh") == F.col("__h")), "left_semi")
    return joined.dropDuplicates([key, "__rh"]).select(*docs.columns)
