"""Distinct products per style, and exact medians."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sales import is_at_least_xxl
from .keys import require_keys


def distinct_values(frame: DataFrame, column: str) -> DataFrame:
    return require_keys(frame.select(column), [column]).distinct()


def qualifying_styles(sold: DataFrame, style: str = "style", size: str = "size") -> DataFrame:
    """Styles with at least one sold row of size XXL or larger."""
    return distinct_values(sold.where(is_at_least_xxl(size)), style)


def distinct_count(frame: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count_distinct(column).alias(name))


def semi_join(frame: DataFrame, members: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur in ``members``."""
    return frame.join(members, keys, "left_semi")


def style_varieties(
    sold: DataFrame,
    group: str = "state",
    month: str = "month",
    style: str = "style",
    sku: str = "sku",
    size: str = "size",
) -> DataFrame:
    """Distinct SKUs per (group, month, style), with a flag for a sold size of XXL or larger.

    The only step that reads the sold rows. Duplicates of one (group, month, style, sku) are
    merged map-side. Rows without group or SKU add no variety but can still qualify a style.
    """
    rows = require_keys(sold, [style]).select(
        group, month, style, sku, is_at_least_xxl(size).alias("large")
    )
    products = rows.groupBy(group, month, style, sku).agg(F.max("large").alias("large"))
    return products.groupBy(group, month, style).agg(
        F.count(sku).alias("variety"), F.max("large").alias("has_large_size")
    )


def exact_median(
    frame: DataFrame, keys: list[str], value: str, median: str = "median", size: str = "group_size"
) -> DataFrame:
    """Median per group (mean of the two middle values for an even count) and group size.

    The percentile aggregate keeps one counter per distinct value and merges counters
    map-side: right for counts, whose distinct values are few. A group of values that hardly
    repeat lies in one task.
    """
    return require_keys(frame, [value]).groupBy(*keys).agg(
        F.median(value).alias(median), F.count(F.lit(1)).alias(size)
    )
