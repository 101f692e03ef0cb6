"""Percentile thresholds per group and statistics of the rows at or above them.

Exact means nearest rank: the value at position ``ceil(p * N)`` of the N sorted values,
without interpolation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keys import join_null_safe, require_keys
from .moments import ROWS, VALUES, group_moments, merged_moments, population_stddev

# The percentile levels and the default accuracy of the sketch.
LEVELS = {"P80": 0.8, "P90": 0.9}
ACCURACY = 10_000


def percentile_rows(frame: DataFrame, keys: list[str], values: str, levels=LEVELS) -> DataFrame:
    """One row per level from an array of thresholds in the order of ``levels``."""
    names = F.array(*[F.lit(name) for name in levels])
    exploded = frame.select(*keys, F.posexplode(values).alias("position", "threshold"))
    return exploded.select(
        *keys,
        F.element_at(names, F.col("position") + 1).alias("percentile_level"),
        F.col("threshold").cast("double").alias("threshold"),
    )


def labelled_levels(rows: DataFrame, keys: list[str], method: str) -> DataFrame:
    return rows.select(
        *keys, F.lit(method).alias("method"), "percentile_level", "threshold"
    )


def approx_percentiles(
    frame: DataFrame, keys: list[str], value: str, accuracy: int = ACCURACY, levels=LEVELS
) -> DataFrame:
    """Approximate thresholds from a mergeable sketch whose size ``accuracy`` bounds."""
    if accuracy <= 0:
        raise ValueError("accuracy must be positive")
    arrays = frame.groupBy(*keys).agg(
        F.percentile_approx(value, list(levels.values()), accuracy).alias("thresholds")
    )
    return labelled_levels(percentile_rows(arrays, keys, "thresholds", levels), keys, "approx")


def value_histogram(
    frame: DataFrame, keys: list[str], value: str, amount: str, scale: int = 2
) -> DataFrame:
    """Moments of ``amount`` per (group, distinct value): the only step that reads all rows.

    Row counts per value are merged map-side, so a group that holds a third of all rows
    arrives as a handful of counters.
    """
    return group_moments(require_keys(frame, [value]), [*keys, value], amount, scale)


def _ranked_levels(histogram: DataFrame, keys: list[str], value: str, levels) -> DataFrame:
    """The histogram rows at or above the exact threshold of each level.

    Values are counted upwards: a row lies at or above the threshold exactly if the count
    up to its value reaches the nearest rank, and the smallest such value is the threshold.
    A window partition holds the distinct values of one group, not its rows, which is small
    for counts; a value that hardly repeats makes it as large as the group.
    """
    group = Window.partitionBy(*keys)
    ordered = group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    counted = histogram.withColumns(
        {"_up_to": F.sum(ROWS).over(ordered), "_group_rows": F.sum(ROWS).over(group)}
    )
    named = F.array(*[
        F.struct(F.lit(name).alias("percentile_level"), F.lit(p).alias("_p"))
        for name, p in levels.items()
    ])
    expanded = counted.select("*", F.inline(named))
    position = F.ceil(F.col("_group_rows").cast("double") * F.col("_p"))
    return expanded.where(F.col("_up_to") >= position)


def exact_percentiles(
    histogram: DataFrame, keys: list[str], value: str, levels=LEVELS
) -> DataFrame:
    """Nearest-rank thresholds from a histogram: one running count, no sort of raw rows."""
    rows = _ranked_levels(histogram, keys, value, levels)
    thresholds = rows.groupBy(*keys, "percentile_level").agg(
        F.min(value).cast("double").alias("threshold")
    )
    return labelled_levels(thresholds, keys, "exact")


def with_group_size(frame: DataFrame, keys: list[str], name: str = "group_size") -> DataFrame:
    """Group size on every row.

    Counting map-side and joining the counts back leaves a dominant group spread over many
    tasks; a window over the group would gather it in one. A null key is a group of its own.
    """
    counts = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return join_null_safe(frame, counts, keys)


def _stddev_or_zero(rows: Column, scale: int) -> Column:
    return F.when(rows >= 2, F.coalesce(population_stddev(scale), F.lit(0.0))).otherwise(0.0)


def band_statistics(merged: DataFrame, keys: list[str], scale: int) -> DataFrame:
    """Statistics per (group, method, level) from the merged moments of the rows above."""
    return merged.select(
        *keys, "method", "percentile_level", "threshold",
        F.col(ROWS).alias("qualifying_order_count"),
        F.col(VALUES).alias("amount_value_count"),
        _stddev_or_zero(F.col(ROWS), scale).alias("amount_stddev_pop"),
    )


def qualifying_stats(
    histogram: DataFrame, thresholds: DataFrame, keys: list[str], value: str, scale: int = 2
) -> DataFrame:
    """Row count, amount count and amount deviation of the rows at or above each threshold.

    The inequality is tested once per distinct value instead of once per row.
    """
    rows = join_null_safe(histogram, thresholds, keys).where(F.col(value) >= F.col("threshold"))
    merged = rows.groupBy(*keys, "method", "percentile_level", "threshold").agg(*merged_moments())
    return band_statistics(merged, keys, scale)


def exact_band_stats(
    histogram: DataFrame, keys: list[str], value: str, levels=LEVELS, scale: int = 2
) -> DataFrame:
    """Exact thresholds and their statistics in one pass over the histogram, without a join.

    The windows, the expansion to levels and the aggregate share one partitioning by group.
    """
    rows = _ranked_levels(histogram, keys, value, levels)
    merged = rows.groupBy(*keys, F.lit("exact").alias("method"), "percentile_level").agg(
        F.min(value).cast("double").alias("threshold"), *merged_moments()
    )
    return band_statistics(merged, keys, scale)
