"""Profiles of group sizes, run times and data quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The group size worth reporting and the estimated bytes per row.
LARGE_GROUP = 1_000
BYTES_PER_ROW = 128


def group_size_profile(
    frame: DataFrame, keys: list[str], large: int = LARGE_GROUP, bytes_per_row: int = BYTES_PER_ROW
) -> DataFrame:
    """One row: rows, groups, largest group, large groups, estimated bytes of the largest."""
    if bytes_per_row <= 0:
        raise ValueError("bytes_per_row must be positive")
    sizes = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    summary = sizes.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("valid_rows"),
        F.count(F.lit(1)).alias("group_count"),
        F.coalesce(F.max("size"), F.lit(0)).alias("maximum_group_rows"),
        F.count_if(F.col("size") > large).alias(f"groups_above_{large}"),
    )
    per_row = F.lit(bytes_per_row).cast("long")
    return summary.withColumns({
        "estimated_bytes_per_row": per_row,
        "estimated_maximum_group_bytes": F.col("maximum_group_rows") * per_row,
    })


def mean_and_sample_sd(samples: DataFrame, label: str, value: str) -> DataFrame:
    """Number of samples, mean and sample deviation per label; 0 deviation for one sample."""
    sd = F.when(F.count(value) < 2, F.lit(0.0)).otherwise(F.stddev_samp(value))
    return samples.groupBy(label).agg(
        F.count(value).alias("runs"), F.avg(value).alias("mean"), sd.alias("sample_stddev")
    )


def field_counters(frame: DataFrame, fields: list[str], date: str, keys: list[str]) -> DataFrame:
    """Rows, nulls per field and date range, per group of ``keys``; one pass."""
    return frame.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f).isNull()).alias(f"null_{f}") for f in fields],
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    )


def merged_counters(counters: DataFrame, fields: list[str]) -> DataFrame:
    """Metric rows from counters of any number of groups."""
    totals = ["rows", *[f"null_{f}" for f in fields]]
    return _metric_rows(counters.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("string").alias(c) for c in totals],
        F.min("first_date").cast("string").alias("first_date"),
        F.max("last_date").cast("string").alias("last_date"),
    ))


def group_metrics(
    base: DataFrame, order: str, group: tuple[str, str], large: int = LARGE_GROUP
) -> DataFrame:
    """Metric rows on repeated order ids and on group sizes.

    Both groupings ride on one scan as grouping sets, counted map-side.
    """
    sizes = base.select(order, *group).groupingSets(
        [[F.col(order)], [F.col(c) for c in group]], F.col(order), *[F.col(c) for c in group]
    ).agg(F.count(F.lit(1)).alias("size"), F.grouping(order).alias("by_group"))
    by_order = (F.col("by_group") == 0) & F.col(order).isNotNull()
    by_group = F.col("by_group") == 1
    for column in group:
        by_group = by_group & F.col(column).isNotNull()

    def largest(condition: Column) -> Column:
        return F.coalesce(F.max(F.when(condition, F.col("size"))), F.lit(0)).cast("string")

    return _metric_rows(sizes.agg(
        F.count_if(by_order & (F.col("size") > 1)).cast("string").alias("repeated_order_ids"),
        largest(by_order).alias("largest_order_rows"),
        largest(by_group).alias("largest_group_rows"),
        F.count_if(by_group & (F.col("size") > large)).cast("string").alias("large_groups"),
    ))


def data_quality_profile(
    base: DataFrame,
    fields: list[str],
    order: str = "order_id",
    date: str = "order_date",
    group: tuple[str, str] = ("sku", "month"),
) -> DataFrame:
    """Metric rows: rows, nulls per field, date range, repeated order ids, group sizes."""
    counters = field_counters(base, fields, date, [])
    return merged_counters(counters, fields).unionByName(group_metrics(base, order, group))


def _metric_rows(one_row: DataFrame) -> DataFrame:
    return one_row.unpivot([], one_row.columns, "metric", "value")
