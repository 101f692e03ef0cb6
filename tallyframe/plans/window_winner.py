"""Best-selling label per group and day over a trailing window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sales import is_bought
from ..functions.text import normalize_dimension
from ..operators.windows import (
    LARGE_GROUP_ROWS,
    best_candidate,
    daily_moments,
    group_window_days,
    trailing_window_moments,
    window_candidates,
)
from ..sources.staging import stage


def bought_rows(
    sales: DataFrame, dimensions: list[str], status: str = "status", qty: str = "qty"
) -> DataFrame:
    """Sold rows with normalized dimension columns."""
    normalized: dict[str, Column] = {c: normalize_dimension(c) for c in dimensions}
    return sales.where(is_bought(status, qty)).withColumns(normalized)


def dynamic_window_winner(
    sales: DataFrame,
    group: str = "state",
    date: str = "order_date",
    label: str = "size",
    amount: str = "amount",
    limit: int = LARGE_GROUP_ROWS,
    scale: int = 2,
    staged: bool = True,
    window_moments=trailing_window_moments,
) -> DataFrame:
    """Winner of every (group, day) with at least one sold row in its trailing window.

    ``staged`` writes the daily moments once; without it the plan stays fully lazy and
    reads the sales a second time for the group volumes.
    """
    sold = bought_rows(sales, [group, label])
    daily = daily_moments(sold, group, date, label, amount, scale)
    if staged:
        daily = stage(daily, "daily-moments")
    days = group_window_days(daily, group, limit=limit)
    candidates = window_candidates(window_moments(daily, days, group, date, label), scale)
    keys = [group, "window_date", "window_days"]
    winners = best_candidate(candidates, keys, label, "frequency", "population_variance")
    return winners.select(
        *keys, F.col(label).alias(f"winning_{label}"), "frequency", "population_variance"
    )
