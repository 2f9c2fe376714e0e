"""The metrics-over-time model: named dimensions, named measures, group by what is asked for."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total_seconds(payload: str = "payload") -> Column:
    """Null when the payload has no such field; an error when it is no number."""
    return F.variant_get(F.col(payload), "$.total_seconds", "double")


DIMENSIONS: dict[str, Callable[[], Column]] = {
    "metric_name": lambda: F.col("metric_name"),
    "last_updated": lambda: F.col("last_updated"),
    "date_trunc_hour": lambda: F.date_trunc("HOUR", "last_updated"),
    "date_trunc_day": lambda: F.date_trunc("DAY", "last_updated"),
}

MEASURES: dict[str, Callable[[], Column]] = {
    "total_seconds": lambda: F.sum("_seconds"),
    "avg_total_seconds": lambda: F.avg("_seconds"),
    "max_total_seconds": lambda: F.max("_seconds"),
    "min_total_seconds": lambda: F.min("_seconds"),
    "record_count": lambda: F.count(F.lit(1)),
}


def rollup(metrics: DataFrame, dimensions: Sequence[str] = (), measures: Sequence[str] = ("record_count",)) -> DataFrame:
    """Measures by dimensions over rows of the metrics table.

    The payload is read once per row, before grouping, and only when a measure
    needs it; the aggregation is partial on the map side.
    """
    columns = [DIMENSIONS[name]().alias(name) for name in dimensions]
    rows = metrics.select(*columns, total_seconds().alias("_seconds"))
    return rows.groupBy(*dimensions).agg(*(MEASURES[name]().alias(name) for name in measures))


def total_records(metrics: DataFrame) -> DataFrame:
    return rollup(metrics)


def average_by_metric(metrics: DataFrame) -> DataFrame:
    return rollup(metrics, ["metric_name"], ["avg_total_seconds"])


def metrics_detail(metrics: DataFrame) -> DataFrame:
    return rollup(
        metrics,
        ["metric_name", "date_trunc_hour"],
        ["total_seconds", "avg_total_seconds", "max_total_seconds", "min_total_seconds"],
    )


def metrics_line(metrics: DataFrame) -> DataFrame:
    return rollup(metrics, ["metric_name", "date_trunc_hour"], ["total_seconds"])
