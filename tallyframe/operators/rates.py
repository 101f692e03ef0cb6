"""Averages over a filter and conditional rates per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import require_keys
from .moments import group_moments, mean_value


def filtered_average(
    frame: DataFrame,
    keys: list[str],
    condition: Column,
    value: str,
    name: str,
    scale: int = 2,
) -> DataFrame:
    """Exact average of the non-null values of the rows that meet ``condition``."""
    rows = require_keys(frame.where(condition), [value, *keys])
    return group_moments(rows, keys, value, scale).select(*keys, mean_value(scale).alias(name))


def percentage(part: Column | str, whole: Column | str) -> Column:
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.lit(100.0) * part.cast("double") / whole.cast("double")


def conditional_rate(
    frame: DataFrame, keys: list[str], condition: Column, whole: str, part: str
) -> DataFrame:
    """Rows per group, rows that meet ``condition``, and their percentage."""
    counts = frame.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(whole), F.count_if(condition).alias(part)
    )
    return counts.withColumn("percentage", percentage(part, whole))
