"""Connected components of an edge table by alternating star contraction.

A large-star step links every larger neighbour of a node to the smallest node around it, a
small-star step does so for the smaller ones; both keep connectivity, and the edges end as one
star around the smallest node of each component. Every step is an aggregation and an equi-join on
nodes: a hub's edges are pre-aggregated before the shuffle, but meet their minimum in one task (two
identifiers a row; Spark's skew join does not split a join behind an aggregate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import materialize


def _towards_min(pairs: DataFrame) -> DataFrame:
    """``(u, v, m)`` of each pair with m the smallest of u and its partners."""
    low = pairs.groupBy("u").agg(F.min("v").alias("low"))
    return pairs.join(low, "u").select("u", "v", F.least("u", "low").alias("m"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``(node, component)`` of every node with an edge to another; component: its smallest node.

    Nodes are of any ordered type; null ends, loops and repeated edges add nothing.
    """
    current = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        f"`{a}` is not null and `{b}` is not null and u > v").distinct()
    current = materialize(current, "edges")
    seen = None
    for _ in range(rounds):
        large = _towards_min(current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        large = large.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _towards_min(large)
        small = small.select("u", F.col("m").alias("v")).unionByName(
            small.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        current = materialize(small, "edges")
        # one row: number of edges and an order-free checksum of them
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    node = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return node.unionByName(roots)


def block_pairs(members: DataFrame, group: list[str], ident: str, size: str, block: int) -> DataFrame:
    """Rows of groups of any size, dealt so that every two rows of a group meet in bounded tasks.

    A group of ``size`` rows is cut by a hash of ``ident`` into blocks of about ``block`` rows. Each
    row goes to the pairs of blocks its own is in: columns ``bi <= bj`` (the pair), ``own`` (which
    of the two). Rows of one block meet in the pair (b, b), of two blocks in their pair.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col(size) / F.lit(block))).cast("int")
    dealt = members.withColumn("__n", blocks).withColumn(
        "own", F.pmod(F.xxhash64(ident, F.lit(17)), F.col("__n")).cast("int"))
    dealt = dealt.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    return dealt.withColumns({"bi": F.least("own", "__other"), "bj": F.greatest("own", "__other")}).drop(
        "__n", "__other")
