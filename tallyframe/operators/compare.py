"""Comparing two threshold tables and the row sets they select."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .moments import ROWS

LEVEL = "percentile_level"


def keyed_difference(
    left: DataFrame, right: DataFrame, keys: list[str], left_name: str, right_name: str
) -> DataFrame:
    """Rows found on one side only, labelled by side, as a bag (duplicates stay).

    Each side is read once, and both are counted per key in one shuffle, merged map-side. Null
    keys are equal to each other.
    """
    both = left.select(*keys, F.lit(True).alias("_left")).unionByName(
        right.select(*keys, F.lit(False).alias("_left"))
    )
    counts = both.groupBy(*keys).agg(
        F.count_if("_left").cast("int").alias("_lefts"),
        F.count_if(~F.col("_left")).cast("int").alias("_rights"),
    )
    alone = counts.where((F.col("_lefts") == 0) | (F.col("_rights") == 0))
    side = F.when(F.col("_lefts") > 0, F.lit(left_name)).otherwise(F.lit(right_name))
    copies = F.array_repeat(side, F.col("_lefts") + F.col("_rights"))
    return alone.select(*keys, F.explode(copies).alias("difference_side"))


def set_difference_counts(
    differences: DataFrame, keys: list[str], left_name: str, right_name: str
) -> DataFrame:
    side = F.col("difference_side")
    return differences.groupBy(*keys).agg(
        F.count_if(side == left_name).alias(f"{left_name}_count"),
        F.count_if(side == right_name).alias(f"{right_name}_count"),
    )


def threshold_deltas(approx: DataFrame, exact: DataFrame, keys: list[str]) -> DataFrame:
    """Both thresholds side by side and ``approx - exact``."""
    on = [*keys, LEVEL]
    left = approx.select(*on, F.col("threshold").alias("approx_threshold"))
    right = exact.select(*on, F.col("threshold").alias("exact_threshold"))
    return left.join(right, on).withColumn(
        "threshold_delta", F.col("approx_threshold") - F.col("exact_threshold")
    )


def qualifying_rows(
    base: DataFrame, thresholds: DataFrame, keys: list[str], value: str, record: str
) -> DataFrame:
    """(keys, level, record) of the rows at or above the threshold of their group."""
    joined = base.join(thresholds, keys).where(F.col(value) >= F.col("threshold"))
    return joined.select(*keys, LEVEL, record)


def _side(value: str):
    """Side on which a value qualifies alone, given both thresholds; null if on both or none."""
    in_approx = F.col(value) >= F.col("approx_threshold")
    in_exact = F.col(value) >= F.col("exact_threshold")
    return F.when(in_approx & ~in_exact, "approx_only").when(in_exact & ~in_approx, "exact_only")


def set_difference_summary(
    histogram: DataFrame, deltas: DataFrame, keys: list[str], value: str
) -> DataFrame:
    """Rows that only one of the two thresholds selects, per (group, level), zeros included.

    A row qualifies on one side only when its value lies between the two thresholds, so the
    counts follow from the histogram; the row sets themselves are never built or joined.
    """
    sided = histogram.join(deltas, keys).withColumn("difference_side", _side(value))

    def rows_on(side: str):
        return F.sum(F.when(F.col("difference_side") == side, F.col(ROWS)).otherwise(0))

    return sided.groupBy(*keys, LEVEL).agg(
        rows_on("approx_only").alias("approx_only_count"),
        rows_on("exact_only").alias("exact_only_count"),
    )


def set_differences(
    base: DataFrame, deltas: DataFrame, keys: list[str], value: str, record: str
) -> DataFrame:
    """The rows that only one of the two thresholds selects, labelled by side.

    Groups with equal thresholds leave before the join with the base rows.
    """
    differing = deltas.where(F.col("threshold_delta") != 0)
    sided = base.join(differing, keys).withColumn("difference_side", _side(value))
    return sided.where(F.col("difference_side").isNotNull()).select(
        *keys, LEVEL, record, "difference_side"
    )


def first_rows(frame: DataFrame, order: list[str], n: int = 100) -> DataFrame:
    """The first ``n`` rows in the given order, by a top-n per partition and a merge."""
    return frame.orderBy(*order).limit(n)
