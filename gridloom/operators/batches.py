"""Latest batch, its members, latest row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_batch(rows: DataFrame, batch: str = "metric_batch_id", updated: str = "last_updated") -> DataFrame:
    """The batch with the newest row: one row, column ``batch``. Ties go to the greater id."""
    newest = rows.groupBy(batch).agg(F.max(updated).alias("_newest"))
    return newest.orderBy(F.desc("_newest"), F.desc(batch)).limit(1).select(batch)


def batch_members(rows: DataFrame, batch: str = "metric_batch_id", updated: str = "last_updated") -> DataFrame:
    """Rows of the latest batch. The one-row side is the only one that is broadcast."""
    return rows.join(F.broadcast(latest_batch(rows, batch, updated)), batch, "left_semi")


def latest_row(rows: DataFrame, order: str = "int_id") -> DataFrame:
    return rows.orderBy(F.desc(order)).limit(1)
