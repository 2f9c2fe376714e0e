"""Nearest-rank latency summary of any number of durations per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A first range holds durations that differ by 1.6 % or less; each further pass cuts the range of a rank into so many.
RANGES_PER_E, CUTS, PASSES = 64, 65_536, 1
# Below a billionth of a second ranges are evenly wide.
FINEST = 1e9

# Figures of the report.
FIGURES = ("min_ms", "p50_ms", "p95_ms", "max_ms")


def latency_summary(df: DataFrame, key: Sequence[str], seconds: str, passes: int = PASSES) -> DataFrame:
    """Per key: count, total, average, minimum, median, 95th percentile and maximum.

    Percentiles are the value at rank ``n // 2`` and ``min(n - 1, int(n * 0.95))``,
    which neither ``percentile`` (interpolates) nor ``percentile_approx`` gives.

    The values are found by counting, not by sorting: equal durations are counted first,
    then the durations of each of some 100,000 ranges. The range that holds a rank is cut
    again ``passes`` times, each time into 65,536, and what is left of it is numbered: of a
    hundred million different durations within 1.6 % of each other, some 1,500. Nothing
    runs before the result is asked for. Durations that are null or not a number are left
    out; a null in a key is a key.
    """
    key = list(key)
    value, exact = F.col("_value"), F.col("_double")
    whole_key = F.struct(*key, F.lit(0).alias("_")).alias("_key")
    rows = df.select(whole_key, F.col(seconds).alias("_value")).where(value.isNotNull() & ~F.isnan(value.cast("double")))
    counted = rows.groupBy("_key", "_value").agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.withColumn("_double", value.cast("double"))
    counted = counted.withColumn("_range", F.floor(F.asinh(exact * FINEST) * RANGES_PER_E))

    n = F.col("iterations")
    whole = counted.groupBy("_key").agg(
        F.sum("_n").alias("iterations"),
        F.sum(value * F.col("_n")).cast("double").alias("total_seconds"),
        F.min(value).alias("min_ms"),
        F.max(value).alias("max_ms"),
    )
    wanted = {"p50_ms": F.floor(n / 2), "p95_ms": F.least(n - 1, F.floor(n * F.lit(0.95)))}
    ranks = whole.select("_key", F.explode(F.array(*(F.struct(F.lit(k).alias("_which"), r.alias("_rank")) for k, r in wanted.items()))).alias("r"))
    ranks = ranks.select("_key", "r.*")

    held = _holding(counted, ["_key"], ranks.join(_ranges(counted, ["_key"]), "_key"))
    inside = counted.join(held, ["_key", "_range"]).drop("_range")
    for _ in range(passes):
        share = (exact - F.col("_low")) / (F.col("_high") - F.col("_low"))
        cut = inside.withColumn("_range", F.when(F.col("_high") > F.col("_low"), F.floor(share * CUTS)).otherwise(0)).drop("_low", "_high")
        place = ["_key", "_which"]
        held = _holding(cut, place, _ranges(cut, [*place, "_rank"]))
        inside = cut.drop("_rank").join(held, [*place, "_range"]).drop("_range")
    up_to = Window.partitionBy("_key", "_which").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum("_n").over(up_to)
    found = inside.select("_key", "_which", "_rank", "_value", "_n", end.alias("_end"))
    found = found.where((F.col("_end") - F.col("_n") <= F.col("_rank")) & (F.col("_rank") < F.col("_end")))
    of_key = found.groupBy("_key").agg(*(F.max(F.when(F.col("_which") == name, value)).alias(name) for name in wanted))
    in_ms = [(F.col(name).cast("double") * 1000).alias(name) for name in FIGURES]
    average = (F.col("total_seconds") / n * 1000).alias("avg_ms")
    return whole.join(of_key, "_key").select(*(F.col("_key")[k].alias(k) for k in key), "iterations", "total_seconds", average, *in_ms)


def _ranges(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Durations in each range, their ends, and how many lie in it and the ranges before."""
    exact = F.col("_double")
    counts = rows.groupBy(*by, "_range").agg(F.sum("_n").alias("_rows"), F.min(exact).alias("_low"), F.max(exact).alias("_high"))
    up_to = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("_end", F.sum("_rows").over(up_to))


def _holding(rows: DataFrame, by: Sequence[str], ranges: DataFrame) -> DataFrame:
    """The range that holds each rank, and the rank inside it."""
    start: Column = F.col("_end") - F.col("_rows")
    held = ranges.where((start <= F.col("_rank")) & (F.col("_rank") < F.col("_end")))
    return held.select("_key", "_which", "_range", (F.col("_rank") - start).alias("_rank"), "_low", "_high")
