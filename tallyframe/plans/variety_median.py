"""Median product variety per group and month over styles sold in size XXL or larger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import month_key
from ..operators.keys import require_keys
from ..operators.variety import exact_median, semi_join, style_varieties
from ..sources.staging import stage
from .window_winner import bought_rows

SCOPES = ("global", "group")


def sold_varieties(sales: DataFrame, group: str = "state", date: str = "order_date") -> DataFrame:
    """Varieties per (group, month, style) of the sold rows.

    Rows are grouped by the first day of the month, which only the varieties turn into text.
    """
    sold = bought_rows(sales, [group, "style", "sku"]).withColumn("month", F.trunc(date, "month"))
    varieties = style_varieties(require_keys(sold, [date]), group=group)
    return varieties.withColumn("month", month_key("month"))


def median_of_varieties(varieties: DataFrame, scope: str, group: str = "state") -> DataFrame:
    """Median over the styles that qualify.

    ``scope="global"``: the style sold a large size anywhere. ``scope="group"``: it did so in
    this very group and month.
    """
    if scope not in SCOPES:
        raise ValueError(f"unknown scope {scope!r}, expected one of {SCOPES}")
    large = varieties.where("has_large_size")
    if scope == "global":
        large = semi_join(varieties, large.select("style").distinct(), ["style"])
    rows = require_keys(large, [group]).where(F.col("variety") > 0)
    return exact_median(
        rows, [group, "month"], "variety", "median_variety", "qualifying_style_count"
    )


def variety_median(
    sales: DataFrame, scope: str = "global", group: str = "state", staged: bool = True
) -> DataFrame:
    varieties = sold_varieties(sales, group)
    if staged and scope == "global":
        varieties = stage(varieties, "style-varieties")
    return median_of_varieties(varieties, scope, group)


def variety_scope_comparison(
    sales: DataFrame, group: str = "state", staged: bool = True
) -> DataFrame:
    """Global medians with the medians of the narrower scope beside them, null if none."""
    varieties = sold_varieties(sales, group)
    if staged:
        varieties = stage(varieties, "style-varieties")
    narrow = median_of_varieties(varieties, "group", group).withColumnsRenamed({
        "median_variety": "local_median_variety",
        "qualifying_style_count": "local_qualifying_style_count",
    })
    return median_of_varieties(varieties, "global", group).join(narrow, [group, "month"], "left")
