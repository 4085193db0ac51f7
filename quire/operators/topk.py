"""Deterministic top-k with a rank column.

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each partition keeps its own k best rows
and only those reach the final merge, so no full sort or shuffle of the input happens. The rank is
numbered afterwards over the k surviving rows only, so the unpartitioned window is harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, order: list[Column], rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows under ``order`` (which must be a total order) plus a 1-based rank."""
    best = df.orderBy(*order).limit(k)
    return best.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
