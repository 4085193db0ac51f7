"""Sinks: Parquet and CSV writers, overwrite by default, paths supplied by the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """Write ``df`` as Parquet (ML vectors round-trip through their struct encoding)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              sort_by: list[str] | None = None) -> None:
    """Write ``df`` as CSV with a header; ``sort_by`` range-sorts right before the write so that
    the part files, read in name order, hold the rows in that order."""
    if sort_by:
        df = df.orderBy(*[F.col(c) for c in sort_by])
    df.write.mode(mode).option("header", "true" if header else "false").csv(path)
