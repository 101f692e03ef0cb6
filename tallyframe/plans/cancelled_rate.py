"""Share of cancelled standard orders with enough long-lived promotions and a low amount."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import token_array, token_count
from ..functions.text import quick_strip, status_contains
from ..operators.keys import left_counts, lookup_join
from ..operators.moments import ROWS, mean_value, moments
from ..operators.rates import filtered_average, percentage
from ..operators.tokens import MIN_SPAN_DAYS, distinct_tokens, valid_token_count
from ..sources.staging import stage

# The labels of the orders in question, of the orders behind the average, and
# the number of long-lived promotions an order needs.
CANCELLED_TOKEN = "CANCELLED"
STANDARD_SERVICE = "STANDARD"
MERCHANT_FULFILMENT = "MERCHANT"
SHIPPED_COURIER_STATUS = "SHIPPED"
MIN_VALID_PROMOTIONS = 3


def cancelled_standard() -> Column:
    return status_contains("status", CANCELLED_TOKEN) & (
        F.col("service_level") == STANDARD_SERVICE
    )


def merchant_shipped() -> Column:
    return (F.col("fulfilment") == MERCHANT_FULFILMENT) & (
        F.col("courier_status") == SHIPPED_COURIER_STATUS
    )


def state_averages(base: DataFrame, scale: int = 2) -> DataFrame:
    return filtered_average(
        base, ["state"], merchant_shipped(), "amount", "state_average_amount", scale
    )


def rate_parts(
    base: DataFrame, min_promotions: int, with_tokens: bool, scale: int = 2
) -> DataFrame:
    """All that the rates need of the rows, by kind, from one scan and one grouping.

    ``average``: moments of the amounts behind the average of a state; ``order``: rows per (state,
    city) in question; ``token``: first and last day of a token; ``candidate``: the orders in
    question that have an amount, as (record, state, city, amount), ``with_tokens`` only those
    with enough tokens, and with their token list. Everything but the candidates shrinks
    map-side to a few rows per task.
    """
    kind, token = F.col("_kind"), quick_strip("_token")
    wanted = cancelled_standard() & F.col("state").isNotNull() & F.col("city").isNotNull()
    candidate = wanted & F.col("amount").isNotNull() & F.col("record_id").isNotNull()
    if with_tokens:
        candidate &= token_count("promotion_ids_raw") >= min_promotions
    rules = {
        "average": merchant_shipped() & F.col("state").isNotNull() & F.col("amount").isNotNull(),
        "order": wanted,
        "token": F.col("promotion_ids_raw").isNotNull() & F.col("order_date").isNotNull(),
        "candidate": candidate,
    }
    listed = base.select("*", F.explode(F.array(*[F.lit(name) for name in rules])).alias("_kind"))
    kept = listed.where(reduce(Column.__or__, [(kind == k) & rule for k, rule in rules.items()]))
    split = F.when(kind == "token", F.split("promotion_ids_raw", ","))
    rows = kept.select("*", F.explode_outer(split).alias("_token")).where(
        (kind != "token") | (F.length(token) > 0)
    )
    in_candidate = kind == "candidate"
    raw = F.col("promotion_ids_raw") if with_tokens else F.lit(None).cast("string")
    return rows.groupBy(
        kind.alias("kind"), F.when(kind != "token", F.col("state")).alias("state"),
        F.when(kind.isin("order", "candidate"), F.col("city")).alias("city"),
        F.when(kind == "token", token).alias("promotion_id"),
        F.when(in_candidate, F.col("record_id")).alias("record_id"),
        F.when(in_candidate, F.col("amount")).alias("amount"),
        F.when(in_candidate, raw).alias("promotion_ids_raw"),
    ).agg(
        *moments(F.when(kind == "average", F.col("amount")), scale),
        F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"),
    )


def conditional_rate_by_city(
    base: DataFrame,
    min_span_days: int = MIN_SPAN_DAYS,
    min_promotions: int = MIN_VALID_PROMOTIONS,
    unique_records: bool = False,
    scale: int = 2,
    strategy: str | None = None,
    staged: bool = True,
) -> DataFrame:
    """Cancelled standard orders per (state, city), the qualifying ones, and their share.

    The rows are read once, into :func:`rate_parts`; with ``staged`` these are written first, so
    that averages, denominators, long-lived tokens and candidates come from one scan and join
    with known sizes. A record id may stand in several rows, whose tokens are counted together:
    that takes a second scan, for the tokens of the candidates' records and of no others. The promise
    ``unique_records=True`` saves it, as candidates then carry all their tokens.
    """
    with_tokens = unique_records and min_promotions >= 1
    parts = rate_parts(base, min_promotions, with_tokens, scale)
    if staged:
        parts = stage(parts, "rate-parts")

    def part(kind: str) -> DataFrame:
        return parts.where(F.col("kind") == kind)

    averages = part("average").select("state", mean_value(scale).alias("state_average_amount"))
    span = F.datediff("last_date", "first_date")
    valid = part("token").where(span >= min_span_days).select("promotion_id")
    candidates = lookup_join(
        part("candidate").select("record_id", "state", "city", "amount", "promotion_ids_raw", ROWS),
        averages, ["state"], "inner", strategy,
    ).where(F.col("amount") < F.col("state_average_amount"))
    if with_tokens:
        candidate_tokens = candidates.select(
            "record_id", "state", "city", F.explode(token_array("promotion_ids_raw")).alias("promotion_id")
        )
        matched = lookup_join(candidate_tokens, valid, ["promotion_id"], "left_semi", strategy)
        counts = matched.groupBy("record_id", "state", "city").count()
        qualified = counts.where(F.col("count") >= min_promotions).withColumn(ROWS, F.lit(1))
    elif min_promotions >= 1:
        asked = base.join(candidates.select("record_id"), "record_id", "left_semi")
        matched = lookup_join(distinct_tokens(asked), valid, ["promotion_id"], "left_semi", strategy)
        counts = valid_token_count(matched).where(F.col("valid_promotion_count") >= min_promotions)
        qualified = candidates.join(counts, "record_id", "left_semi")
    else:
        qualified = candidates
    qualifying = qualified.groupBy("state", "city").agg(F.sum(ROWS).alias("qualifying_orders"))
    whole = part("order").select("state", "city", F.col(ROWS).alias("cancelled_standard_orders"))
    rates = left_counts(whole, qualifying, ["state", "city"], ["qualifying_orders"])
    return _ordered(rates.withColumn(
        "percentage", percentage("qualifying_orders", "cancelled_standard_orders")
    ))


def _ordered(rates: DataFrame) -> DataFrame:
    return rates.select(
        "state", "city", "cancelled_standard_orders", "qualifying_orders", "percentage"
    ).orderBy("state", "city")
