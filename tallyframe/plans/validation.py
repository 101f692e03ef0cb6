"""Contracts of the four main results, and the check over all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.checks import Contract, check_all, non_negative_finite
from ..operators.percentiles import LEVELS
from ..operators.windows import LARGE_GROUP_DAYS, SMALL_GROUP_DAYS


def window_winner_contract() -> Contract:
    variance = F.col("population_variance")
    return Contract(
        name="window_winner",
        schema="state string, window_date date, window_days int, winning_size string, "
               "frequency bigint, population_variance double",
        keys=["state", "window_date"],
        rules={
            "window_days": F.col("window_days").isin(LARGE_GROUP_DAYS, SMALL_GROUP_DAYS),
            "frequency": F.col("frequency") > 0,
            "population_variance": variance.isNull() | non_negative_finite("population_variance"),
        },
    )


def variety_median_contract() -> Contract:
    return Contract(
        name="variety_median",
        schema="state string, month string, median_variety double, qualifying_style_count bigint",
        keys=["state", "month"],
        rules={
            "month": F.col("month").rlike(r"^\d{4}-\d{2}$"),
            "median_variety": F.col("median_variety") >= 1,
            "qualifying_style_count": F.col("qualifying_style_count") > 0,
        },
    )


def cancelled_rate_contract() -> Contract:
    whole, part = F.col("cancelled_standard_orders"), F.col("qualifying_orders")
    return Contract(
        name="cancelled_rate",
        schema="state string, city string, cancelled_standard_orders bigint, "
               "qualifying_orders bigint, percentage double",
        keys=["state", "city"],
        rules={
            "keys_present": F.col("state").isNotNull() & F.col("city").isNotNull(),
            "cancelled_standard_orders": whole > 0,
            "qualifying_orders": (part >= 0) & (part <= whole),
            "percentage": F.col("percentage").between(0, 100),
        },
    )


def percentile_bands_contract(methods: int = 2) -> Contract:
    rows, values = F.col("qualifying_order_count"), F.col("amount_value_count")
    return Contract(
        name="percentile_bands",
        schema="sku string, month string, method string, percentile_level string, "
               "threshold double, qualifying_order_count bigint, amount_value_count bigint, "
               "amount_stddev_pop double",
        keys=["sku", "month", "method", "percentile_level"],
        rules={
            "keys_present": F.col("sku").isNotNull() & F.col("month").isNotNull(),
            "method": F.col("method").isin("approx", "exact"),
            "percentile_level": F.col("percentile_level").isin(*LEVELS),
            "threshold": F.col("threshold") >= 0,
            "qualifying_order_count": rows > 0,
            "amount_value_count": (values >= 0) & (values <= rows),
            "amount_stddev_pop": non_negative_finite("amount_stddev_pop"),
        },
        multiplicity=(["sku", "month"], methods * len(LEVELS)),
    )


def validate_results(
    window_winner: DataFrame,
    variety_median: DataFrame,
    cancelled_rate: DataFrame,
    percentile_bands: DataFrame,
) -> DataFrame:
    """Violations of all four results as one frame; empty when all is well."""
    return check_all([
        (window_winner, window_winner_contract()),
        (variety_median, variety_median_contract()),
        (cancelled_rate, cancelled_rate_contract()),
        (percentile_bands, percentile_bands_contract()),
    ])
