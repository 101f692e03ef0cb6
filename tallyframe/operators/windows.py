"""Trailing day windows per group, and the best label in each window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import following_days
from ..sources.staging import stage
from .keys import require_keys
from .moments import (
    MOMENTS,
    ROWS,
    group_moments,
    merged_moments,
    population_variance,
    signed_sum,
)
from .running import running_sums_by_blocks

# Groups with more sold rows than this look back 5 days, all others 10.
LARGE_GROUP_ROWS = 10_000
LARGE_GROUP_DAYS = 5
SMALL_GROUP_DAYS = 10

#: Days in a block of the blocked running sums.
BLOCK_DAYS = 1024


def count_by(frame: DataFrame, keys: list[str], name: str = "row_count") -> DataFrame:
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def volume_window_days(
    rows: Column | str,
    limit: int = LARGE_GROUP_ROWS,
    large_days: int = LARGE_GROUP_DAYS,
    small_days: int = SMALL_GROUP_DAYS,
) -> Column:
    rows = F.col(rows) if isinstance(rows, str) else rows
    return F.when(rows > limit, F.lit(large_days)).otherwise(F.lit(small_days)).cast("int")


def daily_moments(
    sold: DataFrame, group: str, date: str, label: str, amount: str, scale: int = 2
) -> DataFrame:
    """Moments per (group, day, label): the only step that reads the sold rows.

    A null label stays in, since it counts towards the volume of its group. A null group
    stays in too and is dropped by the steps on the daily rows, where that is cheap.
    """
    return group_moments(require_keys(sold, [date]), [group, date, label], amount, scale)


def group_window_days(daily: DataFrame, group: str, **rule: int) -> DataFrame:
    """Window length of every group, from the number of its sold rows."""
    rows = require_keys(daily, [group])
    volume = rows.groupBy(group).agg(F.sum(ROWS).alias("group_rows"))
    return volume.select(group, volume_window_days("group_rows", **rule).alias("window_days"))


def future_buckets(
    frame: DataFrame, date: str, days: Column | int, name: str = "window_date"
) -> DataFrame:
    """One row per day that looks back on ``date``, days past the last date included."""
    return frame.withColumn(name, F.explode(following_days(date, days)))


def trailing_window_moments(
    daily: DataFrame, window_days: DataFrame, group: str, date: str, label: str
) -> DataFrame:
    """Moments of every (group, window day, label) over the window [d-L, d-1].

    The daily rows are hashed on (group, label) once. The expansion to window days and
    the merge that follows keep that partitioning, so the expanded rows never move. A
    (group, label) pair holds at most one row per calendar day.
    """
    placed = require_keys(daily, [label]).join(window_days, group).repartition(group, label)
    return (
        future_buckets(placed, date, F.col("window_days"))
        .groupBy(group, label, "window_date", "window_days")
        .agg(*merged_moments())
    )


def difference_window_moments(
    daily: DataFrame, window_days: DataFrame, group: str, date: str, label: str
) -> DataFrame:
    """Same result as :func:`trailing_window_moments`, by differences.

    A day's moments enter the window one day later and leave it L+1 days later, so the
    work per day no longer grows with L: prefer this form for long windows.
    """
    placed = require_keys(daily, [label]).join(window_days, group).repartition(group, label)
    keys = [group, label, "window_days"]
    changes = _window_changes(placed, keys, date)
    by_day = Window.partitionBy(group, label).orderBy("day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)
    running = [F.sum(c).over(so_far).alias(c) for c in MOMENTS]
    levels = changes.select(*keys, "day", F.lead("day").over(by_day).alias("next_day"), *running)
    return _days_of_levels(levels, group, label)


def _window_changes(placed: DataFrame, keys: list[str], date: str) -> DataFrame:
    """What enters the windows of each key on a day, less what leaves them."""
    enter = F.struct(F.date_add(date, 1).alias("day"), F.lit(1).alias("sign"))
    leave = F.struct(
        F.date_add(F.col(date), F.col("window_days") + 1).alias("day"), F.lit(-1).alias("sign")
    )
    edges = placed.withColumn("edge", F.explode(F.array(enter, leave)))
    return edges.groupBy(*keys, F.col("edge.day").alias("day")).agg(
        *[signed_sum(c, F.col("edge.sign")).alias(c) for c in MOMENTS]
    )


def _days_of_levels(levels: DataFrame, group: str, label: str) -> DataFrame:
    """One row per day from each level up to the next one."""
    return levels.where(F.col(ROWS) > 0).select(
        group, label,
        F.explode(F.sequence("day", F.date_sub("next_day", 1))).alias("window_date"),
        "window_days", *MOMENTS,
    )


def blocked_window_moments(
    daily: DataFrame, window_days: DataFrame, group: str, date: str, label: str,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """Same result as :func:`difference_window_moments`, summed up in blocks of days.

    The changes of a (group, label) are spread over tasks by day, and each block carries on from
    the totals of the blocks before it, so a long history doesn't sit in one window partition.
    """
    placed = require_keys(daily, [label]).join(window_days, group)
    keys = [group, label, "window_days"]
    changes = _window_changes(placed, keys, date).withColumn("day", F.unix_date("day"))
    levels = running_sums_by_blocks(
        stage(changes, "window-changes"), keys, "day", list(MOMENTS), block_days, "next_day"
    ).withColumns({
        "day": F.date_from_unix_date("day"), "next_day": F.date_from_unix_date("next_day")
    })
    return _days_of_levels(levels, group, label)


def best_candidate(
    candidates: DataFrame, keys: list[str], label: str, frequency: str, variance: str
) -> DataFrame:
    """Most frequent label; ties go to the smaller variance, then to the smaller label.

    An undefined variance loses to any defined one. The minimum of an ordering struct is
    merged map-side. Spark sorts the candidates by key for it, as a struct is no hashable buffer.
    """
    order = F.struct(
        (-F.col(frequency)).alias("negative_frequency"),
        F.col(variance).isNull().alias("undefined"),
        F.col(variance).alias("variance"),
        F.col(label).alias("label"),
    )
    best = candidates.groupBy(*keys).agg(F.min(order).alias("best"))
    return best.select(
        *keys,
        F.col("best.label").alias(label),
        (-F.col("best.negative_frequency")).alias(frequency),
        F.col("best.variance").alias(variance),
    )


def window_candidates(window_moments: DataFrame, scale: int = 2) -> DataFrame:
    """Frequency and population variance of every label in every window."""
    kept = [c for c in window_moments.columns if c not in MOMENTS]
    return window_moments.select(
        *kept,
        F.col(ROWS).alias("frequency"),
        population_variance(scale).alias("population_variance"),
    )
