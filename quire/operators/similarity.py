"""Cosine similarity of every document to one target document, distributed.

Input is a long weight table ``(key, feature, weight)`` -- exact terms or hashed buckets. The target's
weights are joined onto every row by ``feature`` (left outer, broadcast side = the target's own
features only), and one ``groupBy(key)`` then yields both the document norm and the dot product with
the target: a single shuffle of the weight table, no collect, no pairwise loop. All documents are
scored -- a document sharing no feature with the target, or with no features at all, gets 0.0 --
and only the target itself is excluded, so the result has N - 1 rows.

``broadcast_target`` is for targets of a bounded size (hashed weights: at most ``num_features`` rows);
otherwise Spark chooses by the measured bytes. Documents without a key are scored like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import fixed_values as fv
from quire.operators.topk import top_k

def cosine_to_target(weights: DataFrame, keys: DataFrame, target, key: str = "doc_id",
                     feature: str = "term", weight: str = "tfidf",
                     broadcast_target: bool = False, digits: int = 6) -> DataFrame:
    """``(key, similarity double)`` for every key of ``keys`` except ``target``.

    ``target`` is a key value or a Column (e.g. a scalar subquery). Similarity is
    ``dot / (|a| |b|)``, 0.0 when the norm product is 0 or nothing is shared, rounded to ``digits``.
    """
    tgt = target if isinstance(target, Column) else F.lit(target)
    tvec = weights.filter(F.col(key) == tgt).select(F.col(feature), F.col(weight).alias("_tw"))
    tnorm = tvec.select(F.sqrt(F.sum(F.col("_tw") * F.col("_tw")))).scalar()
    side = F.broadcast(tvec) if broadcast_target else tvec
    w = F.col(weight)
    scored = (weights.join(side, feature, "left").groupBy(key)
              .agg(F.sqrt(F.sum(w * w)).alias("_norm"), F.sum(w * F.col("_tw")).alias("_dot")))
    denom = F.col("_norm") * tnorm
    sim = F.when(denom > F.lit(0.0), F.col("_dot") / denom)
    # Null keys stay (no null equals the target) and meet their scores null-safely.
    # The target is removed with an anti join against its own key (distinct: exactly one row,
    # whatever the key's multiplicity). A plain `key != target` filter would be inferred through
    # the outer join into the scoring branch, make it differ from the IDF branch, and cost a
    # second pass over the corpus instead of a reused shuffle.
    target_key = keys.select(key).filter(F.col(key) == tgt).distinct()
    others = keys.select(F.col(key).alias("_key")).join(
        F.broadcast(target_key), F.col("_key") == F.col(key), "left_anti")
    return (others.join(scored, F.col("_key").eqNullSafe(F.col(key)), "left")
            .select(F.col("_key").alias(key), F.round(F.coalesce(sim, F.lit(0.0)), digits).alias("similarity")))


def top_similar(similarities: DataFrame, k: int = fv.TOP_K, key: str = "doc_id") -> DataFrame:
    """The ``k`` most similar documents, ties (e.g. exact copies at 1.0) broken by key."""
    return top_k(similarities, k, [F.col("similarity").desc(), F.col(key)])
