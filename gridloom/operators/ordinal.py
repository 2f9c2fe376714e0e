"""Positions inside a group, without putting the group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_ordinal(df: DataFrame, group: Sequence[str], order: str, name: str, chunk_rows: int = 32_768) -> DataFrame:
    """Adds ``name``: 0-based position by ``order``, an integer that is unique in its group.

    Counts per (group, chunk of ``order``) are summed up across chunks; the
    numbering itself runs inside chunks of at most ``chunk_rows`` rows.
    """
    group = list(group)
    chunk = [*group, "_chunk"]
    rows = df.withColumn("_chunk", F.floor(F.col(order) / chunk_rows))
    earlier = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*chunk)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*chunk, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy(*chunk).orderBy(order))
    return (
        rows.withColumn("_at", inside)
        .join(starts, chunk)
        .withColumn(name, F.col("_start") + F.col("_at") - 1)
        .drop("_chunk", "_at", "_start")
    )
