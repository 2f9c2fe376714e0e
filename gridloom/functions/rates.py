"""Ratios that survive a zero divisor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Assumed size of one collected row: an 8-byte id and a 32-character payload.
ROW_BYTES = 40


def guarded_ratio(amount: Column, divisor: Column) -> Column:
    """``amount / divisor``, +infinity when the divisor is 0."""
    return F.when(divisor == 0, F.lit(float("inf"))).otherwise(amount.cast("double") / divisor.cast("double"))


def approx_mb_per_second(rows: Column, seconds: Column) -> Column:
    return guarded_ratio(rows * F.lit(ROW_BYTES) / F.lit(1e6), seconds)
