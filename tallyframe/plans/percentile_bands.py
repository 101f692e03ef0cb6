"""Promotion-count percentiles per (SKU, month) and the amounts at or above them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import compare
from ..operators.keys import require_keys
from ..operators.moments import ROWS
from ..operators.percentiles import (
    ACCURACY,
    LEVELS,
    approx_percentiles,
    exact_band_stats,
    exact_percentiles,
    qualifying_stats,
    value_histogram,
)
from ..operators.profile import group_size_profile
from ..operators.tokens import with_token_count
from ..sources.staging import stage

KEYS = ["sku", "month"]
VALUE = "promotion_count"
METHODS = ("approx", "exact", "both")


def sku_month_base(base: DataFrame, unique_records: bool = False) -> DataFrame:
    """Rows with all keys present, and the number of promotions of each record.

    Counting happens before rows without keys are dropped, since with repeated record ids
    such a row may still carry tokens.
    """
    counted = with_token_count(base, unique_records=unique_records)
    kept = require_keys(counted, ["record_id", *KEYS, "order_date"])
    return kept.select("record_id", *KEYS, VALUE, "amount")


def amount_histogram(sku_month: DataFrame, scale: int = 2, staged: bool = False) -> DataFrame:
    histogram = value_histogram(sku_month, KEYS, VALUE, "amount", scale)
    return stage(histogram, "amount-histogram") if staged else histogram


def percentile_band_stats(
    sku_month: DataFrame,
    method: str = "both",
    accuracy: int = ACCURACY,
    levels=LEVELS,
    scale: int = 2,
    staged: bool = False,
) -> DataFrame:
    """Thresholds and statistics of the rows at or above them, by method and level.

    The exact method reads the rows once. The approximate one reads them a second time for
    its sketches. Both methods share the histogram: its shuffle is reused within the plan, or it
    is written first if ``staged``, which pays where the plan is run more than once.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}, expected one of {METHODS}")
    histogram = amount_histogram(sku_month, scale, staged and method == "both")
    if method == "exact":
        return exact_band_stats(histogram, KEYS, VALUE, levels, scale)
    thresholds = approx_percentiles(sku_month, KEYS, VALUE, accuracy, levels)
    approx = qualifying_stats(histogram, thresholds, KEYS, VALUE, scale)
    if method == "approx":
        return approx
    return approx.unionByName(exact_band_stats(histogram, KEYS, VALUE, levels, scale))


def ordered_band_stats(sku_month: DataFrame, **options) -> DataFrame:
    """All methods in one frame, in the order of its key."""
    return percentile_band_stats(sku_month, "both", **options).orderBy(
        *KEYS, "method", "percentile_level"
    )


def row_counts(sku_month: DataFrame, staged: bool = False) -> DataFrame:
    """Rows per (group, distinct value): all that a comparison of thresholds needs."""
    counts = require_keys(sku_month, [VALUE]).groupBy(*KEYS, VALUE).agg(
        F.count(F.lit(1)).alias(ROWS)
    )
    return stage(counts, "row-counts") if staged else counts


def compare_methods(
    sku_month: DataFrame,
    accuracy: int = ACCURACY,
    levels=LEVELS,
    staged: bool = True,
    approx: DataFrame | None = None,
    exact: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Threshold deltas, counts of differing rows, and all differing rows.

    ``approx`` and ``exact`` are threshold frames to compare, stored or made in any way; those
    not given are computed. The approximate thresholds are sketched once: ``staged`` keeps the
    three frames on the same thresholds, as a sketch may come out differently when its
    partitions merge anew.
    """
    histogram = row_counts(sku_month, staged)
    if exact is None:
        exact = exact_percentiles(histogram, KEYS, VALUE, levels)
    if approx is None:
        approx = approx_percentiles(sku_month, KEYS, VALUE, accuracy, levels)
    deltas = compare.threshold_deltas(approx, exact, KEYS)
    if staged:
        deltas = stage(deltas, "threshold-deltas")
    summary = compare.set_difference_summary(histogram, deltas, KEYS, VALUE)
    differences = compare.set_differences(sku_month, deltas, KEYS, VALUE, "record_id")
    return deltas, summary, differences


def threshold_deltas(sku_month: DataFrame, **options) -> DataFrame:
    return compare_methods(sku_month, **options)[0].orderBy(*KEYS, compare.LEVEL)


def set_difference_summary(sku_month: DataFrame, **options) -> DataFrame:
    return compare_methods(sku_month, **options)[1].orderBy(*KEYS, compare.LEVEL)


def set_difference_examples(sku_month: DataFrame, n: int = 100, **options) -> DataFrame:
    differences = compare_methods(sku_month, **options)[2]
    return compare.first_rows(differences, [*KEYS, compare.LEVEL, "record_id"], n)


def sku_month_profile(sku_month: DataFrame, **options) -> DataFrame:
    return group_size_profile(sku_month, KEYS, **options)
