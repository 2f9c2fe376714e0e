"""Totals and projections that the workloads time, over any columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

TOTAL, GROUP, COUNT, SUM, PAYLOAD = "total", "bucket", "members", "bucket_sum", "payload"


def times_itself(value: Column) -> Column:
    return value * value


# The same through a scalar Python function, to see what the round trip costs.
times_itself_in_python = F.udf(lambda value: value**2, LongType())


def total_of(df: DataFrame, value: Column) -> DataFrame:
    return df.select(F.sum(value).alias(TOTAL))


def totals_by(df: DataFrame, key: Column, value: Column) -> DataFrame:
    """Rows and sum of ``value`` per ``key``; a task sends one row per key it met."""
    return df.groupBy(key.alias(GROUP)).agg(F.count("*").alias(COUNT), F.sum(value).alias(SUM))


def total_of_squares(df: DataFrame, column: str, square: Callable[[Column], Column] = times_itself) -> DataFrame:
    return total_of(df, square(F.col(column)))


def with_digest(df: DataFrame, column: str) -> DataFrame:
    """``df`` and the md5 of a column's text."""
    return df.select("*", F.md5(F.col(column).cast("string")).alias(PAYLOAD))
