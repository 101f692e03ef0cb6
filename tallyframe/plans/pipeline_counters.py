"""How many rows and groups pass each step of the window and variety queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sales import is_at_least_xxl
from ..functions.text import month_key
from ..operators.keys import any_missing
from ..operators.moments import ROWS
from ..sources.staging import stage
from .window_winner import bought_rows

COUNTER_COLUMNS = ("counter", "rows")


def _rows(frame: DataFrame, counters: dict[str, Column]) -> DataFrame:
    """One row per counter from one aggregate over ``frame``."""
    held = frame.agg(*[
        F.coalesce(value, F.lit(0)).cast("bigint").alias(name) for name, value in counters.items()
    ])
    parts = [F.struct(F.lit(name).alias("counter"), F.col(name).alias("rows")) for name in counters]
    return held.select(F.inline(F.array(*parts)))


def variety_counters(sales: DataFrame, group: str = "state", date: str = "order_date") -> DataFrame:
    """Counters of the variety median: sold rows by what becomes of them, and its groups.

    The sales are read once, into staged row counts per (group, month, style, SKU).
    """
    keys = [group, "style", "sku"]
    sold = bought_rows(sales, [*keys, "size"]).withColumn("month", month_key(date))
    products = stage(
        sold.groupBy(*keys, "month").agg(
            F.count(F.lit(1)).alias("n"), F.max(is_at_least_xxl("size")).alias("large")
        ), "sold-products",
    )
    large = products.where("large").select("style").distinct().withColumn("qualifies", F.lit(True))
    known = products.join(large, "style", "left").withColumn(
        "qualifies", F.coalesce("qualifies", F.lit(False))
    )
    missing, qualifies = any_missing(keys), F.col("qualifies")
    rows = _rows(known, {
        "bought_complete_rows": F.sum(F.when(~missing & qualifies, F.col("n"))),
        "non_qualifying_style_rows": F.sum(F.when(~missing & ~qualifies, F.col("n"))),
        "missing_dimension_rows": F.sum(F.when(missing, F.col("n"))),
    })
    styles = known.where(~missing & qualifies).groupBy(group, "month", "style").agg(
        F.count(F.lit(1)).alias("skus")
    )
    groups = styles.groupBy(group, "month").agg(F.count(F.lit(1)).alias("styles"))
    return rows.unionByName(_rows(groups, {
        "qualifying_styles": F.sum("styles"), "state_month_groups": F.count(F.lit(1)),
    }))


def bucket_counters(daily: DataFrame, window_days: DataFrame, group: str, label: str) -> DataFrame:
    """How many (row, window day) pairs the trailing windows stand for."""
    placed = daily.where(F.col(label).isNotNull()).join(window_days, group)
    return _rows(placed, {"buckets_emitted": F.sum(F.col(ROWS) * F.col("window_days"))})


def pipeline_counters(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
