"""Joins, aggregates, windows, ordering and set operations on whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import token_count
from ..functions.text import month_key
from ..operators import compare
from ..operators.keys import (
    JOIN_STRATEGIES,
    dedup,
    existing_values,
    left_counts,
    lookup_join,
)
from ..operators.moments import (
    ROWS,
    finished_moments,
    group_moments,
    mean_value,
    minor_units,
    population_variance,
)
from ..operators.percentiles import (
    LEVELS,
    approx_percentiles,
    exact_percentiles,
    qualifying_stats,
    value_histogram,
    with_group_size,
)
from ..operators.profile import data_quality_profile, group_size_profile, mean_and_sample_sd
from ..operators.rates import conditional_rate, filtered_average
from ..operators.running import percentiles_by_blocks
from ..operators.selection import median_by_selection, percentiles_by_selection
from ..operators.sketches import (
    RANK_ERROR,
    merged_sketches,
    rank_errors,
    sketch_percentiles,
    sketch_table,
)
from ..operators.tokens import (
    lifespans,
    long_lived,
    per_record_counts,
    temporally_valid_tokens,
    tokens,
    valid_token_count,
    with_token_count,
)
from ..operators.variety import (
    distinct_count,
    exact_median,
    qualifying_styles,
    semi_join,
)
from ..operators.windows import (
    best_candidate,
    blocked_window_moments,
    count_by,
    daily_moments,
    difference_window_moments,
    group_window_days,
    trailing_window_moments,
    volume_window_days,
    window_candidates,
)
from ..plans.cancelled_rate import merchant_shipped, state_averages
from ..plans.percentile_bands import KEYS, VALUE, amount_histogram, sku_month_base
from ..plans.window_winner import bought_rows
from ..sources.bucketed import bucketed_table
from ..sources.staging import stage
from ..sources.star_schema import line_sales, order_sales, table
from .registry import query

# The span in days that splits the promotions of the generated tables, and levels that differ
# from the usual ones.
SPAN_DAYS = 2350
OTHER_LEVELS = {"P80": 0.5, "P90": 0.95}

SETS = [*KEYS, compare.LEVEL, "record_id"]


def sold(spark, sf) -> DataFrame:
    rows = bought_rows(line_sales(spark, sf), ["state", "style", "sku", "size"])
    return rows.withColumn("month", month_key("order_date"))


def volume_limit(spark, sf) -> int:
    return middle_volume(line_sales(spark, sf))


def middle_volume(sales: DataFrame) -> int:
    """The volume above which a state counts as large: midway between the extremes, so that
    both window lengths occur in tables of any size."""
    volumes = count_by(bought_rows(sales, ["state"]), ["state"], "volume")
    low, high = volumes.agg(F.min("volume"), F.max("volume")).first()
    return ((low or 0) + (high or 0)) // 2


def sold_days(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = bought_rows(line_sales(spark, sf), ["state", "size"])
    daily = stage(daily_moments(rows, "state", "order_date", "size", "amount"), "daily-moments")
    return daily, group_window_days(daily, "state", limit=volume_limit(spark, sf))


def order_base(spark, sf) -> DataFrame:
    return sku_month_base(order_sales(spark, sf), unique_records=True)


def repeated_rows(spark, sf) -> DataFrame:
    """A sale row per line item: the record id is that of the order and repeats, with other
    tokens in each row."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("record_id"),
        F.concat(
            F.lit("PROMO-"), (F.col("l_partkey") % 500).cast("string"), F.lit(", PROMO-"),
            (F.col("l_suppkey") % 50).cast("string"),
        ).alias("promotion_ids_raw"),
    )
    return order_sales(spark, sf).drop("promotion_ids_raw").join(lines, "record_id")


# Joins

@query("j1_left_join_counts", """
    SELECT o_orderkey AS record_id, coalesce(token_count, 0) AS token_count
    FROM orders LEFT JOIN (SELECT record_id, count(*) AS token_count FROM order_tokens
        GROUP BY record_id) AS t ON o_orderkey = t.record_id""")
def _(spark, sf):
    sales = order_sales(spark, sf)
    counts = count_by(tokens(sales), ["record_id"], "token_count")
    return left_counts(sales.select("record_id"), counts, ["record_id"], ["token_count"])


@query("j2_left_join_average", """
    SELECT record_id, state, round(state_average_amount, 6) AS state_average_amount
    FROM order_sales LEFT JOIN state_averages USING (state)""")
def _(spark, sf):
    sales = order_sales(spark, sf)
    joined = lookup_join(sales, state_averages(sales), ["state"], "left")
    return joined.select(
        "record_id", "state", F.round("state_average_amount", 6).alias("state_average_amount")
    )


@query("j3_semi_join_tokens", """
    SELECT record_id, promotion_id FROM order_tokens
    WHERE promotion_id IN (SELECT promotion_id FROM lifespans WHERE span_days >= 2350)""")
def _(spark, sf):
    rows = tokens(order_sales(spark, sf))
    valid = long_lived(rows, SPAN_DAYS)
    return semi_join(rows, valid, ["promotion_id"]).select("record_id", "promotion_id")


@query("j4_equi_join_with_threshold", "SELECT * FROM exact_qualifying")
def _(spark, sf):
    base = order_base(spark, sf)
    thresholds = exact_percentiles(amount_histogram(base), KEYS, VALUE)
    return compare.qualifying_rows(base, thresholds, KEYS, VALUE, "record_id")


def qualifying_pair(spark, sf) -> tuple[DataFrame, DataFrame]:
    base = stage(order_base(spark, sf), "order-base")
    histogram = amount_histogram(base, staged=True)
    return tuple(
        compare.qualifying_rows(
            base, exact_percentiles(histogram, KEYS, VALUE, levels), KEYS, VALUE, "record_id"
        )
        for levels in (OTHER_LEVELS, {"P80": 0.8, "P90": 0.9})
    )


@query("j5_anti_join_both_ways", "SELECT * FROM differences")
def _(spark, sf):
    other, usual = qualifying_pair(spark, sf)
    return compare.keyed_difference(other, usual, SETS, "approx_only", "exact_only")


def other_deltas(histogram: DataFrame) -> DataFrame:
    other = exact_percentiles(histogram, KEYS, VALUE, OTHER_LEVELS)
    return compare.threshold_deltas(other, exact_percentiles(histogram, KEYS, VALUE), KEYS)


@query("j6_join_thresholds", """
    SELECT l.sku, l.month, l.percentile_level, l.threshold AS approx_threshold,
           e.threshold AS exact_threshold, l.threshold - e.threshold AS threshold_delta
    FROM lower_thresholds AS l JOIN exact_thresholds AS e
        ON l.sku = e.sku AND l.month = e.month AND l.percentile_level = e.percentile_level""")
def _(spark, sf):
    return other_deltas(amount_histogram(order_base(spark, sf), staged=True))


@query("j7_left_join_zero_differences", """
    SELECT sku, month, percentile_level, coalesce(approx_only_count, 0) AS approx_only_count,
           coalesce(exact_only_count, 0) AS exact_only_count
    FROM exact_thresholds LEFT JOIN difference_counts USING (sku, month, percentile_level)""")
def _(spark, sf):
    keys = [*KEYS, compare.LEVEL]
    other, usual = qualifying_pair(spark, sf)
    differences = compare.keyed_difference(other, usual, SETS, "approx_only", "exact_only")
    counts = compare.set_difference_counts(differences, keys, "approx_only", "exact_only")
    groups = usual.select(*keys).distinct()
    return left_counts(groups, counts, keys, ["approx_only_count", "exact_only_count"])


@query("j8_lookup_join_window_days", """
    SELECT state, order_date, size, window_days, count(*) AS rows
    FROM bought JOIN state_days USING (state) GROUP BY ALL""")
def _(spark, sf):
    daily, days = sold_days(spark, sf)
    return lookup_join(daily, days, ["state"]).select(
        "state", "order_date", "size", "window_days", F.col(ROWS).alias("rows")
    )


@query("j9_semi_join_styles", """
    SELECT state, month, style, sku, count(*) AS rows FROM bought
    WHERE style IN (SELECT style FROM styles) GROUP BY ALL""")
def _(spark, sf):
    rows = sold(spark, sf)
    products = count_by(rows, ["state", "month", "style", "sku"], "rows")
    return lookup_join(products, qualifying_styles(rows), ["style"], "left_semi")


@query("j10_join_strategies", """
    SELECT strategy, state, count(*) AS rows, count(state_average_amount) AS with_average
    FROM order_sales LEFT JOIN state_averages USING (state),
         (SELECT unnest(['broadcast', 'merge', 'shuffle_hash']) AS strategy)
    GROUP BY ALL""")
def _(spark, sf):
    sales = order_sales(spark, sf)
    averages = state_averages(sales)
    parts = []
    for strategy in JOIN_STRATEGIES:
        joined = lookup_join(sales, averages, ["state"], "left", strategy)
        parts.append(joined.groupBy(F.lit(strategy).alias("strategy"), "state").agg(
            F.count(F.lit(1)).alias("rows"), F.count("state_average_amount").alias("with_average")
        ))
    return reduce(DataFrame.unionByName, parts)


@query("j1_bucketed_left_join", """
    SELECT o_orderkey AS record_id, coalesce(token_count, 0) AS token_count
    FROM orders LEFT JOIN (SELECT record_id, count(*) AS token_count FROM order_tokens
        GROUP BY record_id) AS t ON o_orderkey = t.record_id""")
def _(spark, sf):
    """Orders and their tokens in buckets of the record id: counting and joining take no shuffle."""
    sales = order_sales(spark, sf)
    orders = bucketed_table(sales.select("record_id"), ["record_id"], "order-buckets")
    rows = bucketed_table(tokens(sales, unique_records=True), ["record_id"], "token-buckets")
    counts = count_by(rows, ["record_id"], "token_count")
    return left_counts(orders, counts.hint("merge"), ["record_id"], ["token_count"])


@query("j10_bucketed_strategies", """
    SELECT strategy, state, count(*) AS rows, count(token_count) AS with_tokens
    FROM order_sales LEFT JOIN (SELECT record_id, count(*) AS token_count FROM order_tokens
             GROUP BY record_id) USING (record_id),
         (SELECT unnest(['broadcast', 'merge', 'shuffle_hash']) AS strategy)
    GROUP BY ALL""")
def _(spark, sf):
    """Each strategy over the same two bucketed tables."""
    sales = order_sales(spark, sf)
    orders = bucketed_table(sales.select("record_id", "state"), ["record_id"], "order-buckets")
    counts = bucketed_table(
        count_by(tokens(sales), ["record_id"], "token_count"), ["record_id"], "count-buckets"
    )
    return reduce(DataFrame.unionByName, [
        lookup_join(orders, counts, ["record_id"], "left", strategy).groupBy(
            F.lit(strategy).alias("strategy"), "state"
        ).agg(F.count(F.lit(1)).alias("rows"), F.count("token_count").alias("with_tokens"))
        for strategy in JOIN_STRATEGIES
    ])


# Aggregates

@query("g1_count_by", "SELECT state, count(*) AS row_count FROM bought GROUP BY state")
def _(spark, sf):
    return count_by(sold(spark, sf), ["state"])


@query("g2_volume_window_days", "SELECT * FROM state_days")
def _(spark, sf):
    counts = count_by(sold(spark, sf), ["state"])
    return counts.select(
        "state", volume_window_days("row_count", limit=volume_limit(spark, sf)).alias("window_days")
    )


def as_text(frame: DataFrame) -> DataFrame:
    """Wide sums as text, since engines differ in the type of an integer sum."""
    finished = finished_moments(frame)
    return finished.withColumns(
        {c: F.col(c).cast("string") for c in ("value_sum", "value_square_sum")}
    )


@query("g3_moments", """
    SELECT state, size, count(*) AS row_count, count(cents) AS value_count,
           CAST(coalesce(sum(cents), 0) AS VARCHAR) AS value_sum,
           CAST(coalesce(sum(cents * cents), 0) AS VARCHAR) AS value_square_sum
    FROM bought GROUP BY state, size""")
def _(spark, sf):
    return as_text(group_moments(sold(spark, sf), ["state", "size"], "amount"))


@query("g4_population_variance", """
    SELECT state, style, CASE WHEN count(cents) > 0 THEN CAST(
               count(cents) * sum(cents * cents) - sum(cents) * sum(cents) AS DOUBLE)
               / CAST(count(cents) AS DOUBLE) / CAST(count(cents) AS DOUBLE) / 10000.0 END
               AS variance,
           CAST(sum(cents) AS DOUBLE) / count(cents) / 100.0 AS mean_amount
    FROM bought GROUP BY state, style""")
def _(spark, sf):
    grouped = group_moments(sold(spark, sf), ["state", "style"], "amount")
    return grouped.select(
        "state", "style", population_variance().alias("variance"),
        mean_value().alias("mean_amount"),
    )


@query("g4_variance_of_four_decimals", """
    SELECT l_suppkey AS supplier, CAST(
               count(*) * sum(units * units) - sum(units) * sum(units) AS DOUBLE)
               / CAST(count(*) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 100000000.0 AS variance
    FROM (SELECT l_suppkey, CAST(round(l_extendedprice * (1 - l_discount) * 10000) AS HUGEINT)
              AS units FROM lineitem)
    GROUP BY l_suppkey""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("supplier"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("revenue"),
    )
    grouped = group_moments(lines, ["supplier"], "revenue", scale=4)
    return grouped.select("supplier", population_variance(scale=4).alias("variance"))


@query("g5_best_candidate", """
    SELECT state, size AS size, frequency, population_variance FROM (
        SELECT state, size, count(*) AS frequency, CASE WHEN count(cents) > 0 THEN CAST(
            count(cents) * sum(cents * cents) - sum(cents) * sum(cents) AS DOUBLE)
            / CAST(count(cents) AS DOUBLE) / CAST(count(cents) AS DOUBLE) / 10000.0 END
            AS population_variance
        FROM bought GROUP BY state, size)
    QUALIFY row_number() OVER (PARTITION BY state
        ORDER BY frequency DESC, population_variance ASC NULLS LAST, size) = 1""")
def _(spark, sf):
    candidates = window_candidates(group_moments(sold(spark, sf), ["state", "size"], "amount"))
    return best_candidate(candidates, ["state"], "size", "frequency", "population_variance")


@query("g6_distinct_values", "SELECT style FROM styles")
def _(spark, sf):
    return qualifying_styles(sold(spark, sf))


@query("g7_distinct_count", """
    SELECT state, month, style, count(DISTINCT sku) AS variety FROM bought GROUP BY ALL""")
def _(spark, sf):
    return distinct_count(sold(spark, sf), ["state", "month", "style"], "sku", "variety")


@query("g8_exact_median", """
    SELECT state, median(variety) AS median, count(*) AS group_size FROM (
        SELECT state, style, count(DISTINCT sku) AS variety FROM bought GROUP BY state, style)
    GROUP BY state""")
def _(spark, sf):
    varieties = distinct_count(sold(spark, sf), ["state", "style"], "sku", "variety")
    return exact_median(varieties, ["state"], "variety")


@query("g8_median_by_selection", """
    SELECT state, median(variety) AS median, count(*) AS group_size FROM (
        SELECT state, style, count(DISTINCT sku) AS variety FROM bought GROUP BY state, style)
    GROUP BY state""")
def _(spark, sf):
    varieties = distinct_count(sold(spark, sf), ["state", "style"], "sku", "variety")
    return median_by_selection(varieties, ["state"], "variety")


@query("g8_median_of_large_groups", """
    SELECT l_linestatus, median(l_extendedprice) AS median, count(*) AS group_size
    FROM lineitem GROUP BY l_linestatus""")
def _(spark, sf):
    """Two groups with almost as many distinct values as rows."""
    rows = table(spark, sf, "lineitem")
    return median_by_selection(rows, ["l_linestatus"], "l_extendedprice", scale=2, salt_values=1000)


@query("g9_lifespans", "SELECT * FROM lifespans")
def _(spark, sf):
    return lifespans(tokens(order_sales(spark, sf)))


@query("g10_temporally_valid_tokens", """
    SELECT record_id, order_date, promotion_id
    FROM order_tokens JOIN order_sales USING (record_id)
    WHERE promotion_id IN (SELECT promotion_id FROM lifespans WHERE span_days >= 2350)""")
def _(spark, sf):
    return temporally_valid_tokens(order_sales(spark, sf), SPAN_DAYS)


@query("g11_valid_token_count", "SELECT * FROM valid_counts")
def _(spark, sf):
    return valid_token_count(temporally_valid_tokens(order_sales(spark, sf), SPAN_DAYS))


@query("g12_token_count", "SELECT record_id, promotion_count FROM order_sales")
def _(spark, sf):
    return with_token_count(order_sales(spark, sf)).select("record_id", "promotion_count")


@query("g12_per_record_counts", "SELECT record_id, promotion_count FROM order_sales")
def _(spark, sf):
    return per_record_counts(order_sales(spark, sf))


@query("g12_token_count_repeated_records", """
    SELECT l_orderkey, l_linenumber, l_partkey, promotion_count
    FROM lineitem JOIN (SELECT l_partkey AS k, count(DISTINCT l_linenumber) AS promotion_count
        FROM lineitem GROUP BY l_partkey) ON l_partkey = k""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_linenumber").cast("string").alias("promotion_ids_raw"),
    )
    counted = with_token_count(lines, record="l_partkey", unique_records=False)
    return counted.drop("promotion_ids_raw")


@query("g13_filtered_average", """
    SELECT state, round(state_average_amount, 6) AS average FROM state_averages""")
def _(spark, sf):
    averages = filtered_average(
        order_sales(spark, sf), ["state"], merchant_shipped(), "amount", "average"
    )
    return averages.select("state", F.round("average", 6).alias("average"))


@query("g14_conditional_rate", """
    SELECT state, month, count(*) AS orders, count_if(promotion_count >= 3) AS promoted_orders,
           100.0::DOUBLE * count_if(promotion_count >= 3) / count(*) AS percentage
    FROM order_sales GROUP BY state, month""")
def _(spark, sf):
    counted = with_token_count(order_sales(spark, sf))
    return conditional_rate(
        counted, ["state", "month"], F.col("promotion_count") >= 3, "orders", "promoted_orders"
    )


@query("g15_approx_percentiles", "SELECT * FROM approx_thresholds")
def _(spark, sf):
    return approx_percentiles(order_base(spark, sf), KEYS, VALUE)


@query("g15_sketch_percentiles", """
    SELECT sku, month, 'sketch' AS method, percentile_level, threshold FROM exact_thresholds""")
def _(spark, sf):
    """Daily sketches, stored, then merged to months: exact for groups of this size."""
    rows = order_sales(spark, sf).withColumn("promotion_count", token_count("promotion_ids_raw"))
    daily = stage(sketch_table(rows, ["sku", "order_date"], VALUE), "daily-sketches")
    months = merged_sketches(daily, ["sku", month_key("order_date").alias("month")])
    return sketch_percentiles(months, KEYS)


@query("g15_sketch_rank_errors", """
    SELECT l_linestatus, percentile_level, count(*) AS group_rows, TRUE AS within_bound
    FROM lineitem, levels GROUP BY ALL""")
def _(spark, sf):
    """Sketches per ship day, merged to all days; the ranks of their thresholds are counted."""
    keys = ["l_linestatus"]
    rows = table(spark, sf, "lineitem").withColumn("cents", minor_units("l_extendedprice"))
    daily = stage(sketch_table(rows, [*keys, "l_shipdate"], "cents"), "daily-sketches")
    thresholds = stage(sketch_percentiles(merged_sketches(daily, keys), keys), "sketch-thresholds")
    errors = rank_errors(rows, thresholds, keys, "cents")
    return errors.select(
        *keys, "percentile_level", "group_rows", (F.col("rank_error") <= 2 * RANK_ERROR).alias("within_bound")
    )


@query("g16_qualifying_stats", """
    SELECT sku, month, method, percentile_level, threshold, qualifying_order_count,
           amount_value_count, round(amount_stddev_pop, 6) AS amount_stddev_pop
    FROM exact_stats""")
def _(spark, sf):
    histogram = amount_histogram(order_base(spark, sf), staged=True)
    stats = qualifying_stats(histogram, exact_percentiles(histogram, KEYS, VALUE), KEYS, VALUE)
    return stats.withColumn("amount_stddev_pop", F.round("amount_stddev_pop", 6))


@query("g17_set_difference_counts", "SELECT * FROM difference_counts")
def _(spark, sf):
    other, usual = qualifying_pair(spark, sf)
    differences = compare.keyed_difference(other, usual, SETS, "approx_only", "exact_only")
    return compare.set_difference_counts(
        differences, [*KEYS, compare.LEVEL], "approx_only", "exact_only"
    )


@query("g18_group_size_profile", """
    SELECT CAST(sum(n) AS BIGINT) AS valid_rows, count(*) AS group_count,
           max(n) AS maximum_group_rows, count_if(n > 4) AS groups_above_4,
           CAST(64 AS BIGINT) AS estimated_bytes_per_row,
           max(n) * 64 AS estimated_maximum_group_bytes
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)""")
def _(spark, sf):
    return group_size_profile(table(spark, sf, "lineitem"), ["l_orderkey"], 4, 64)


@query("g19_mean_and_sample_sd", """
    SELECT event_type, count(value) AS runs, round(avg(value), 6) AS mean,
           round(CASE WHEN count(value) < 2 THEN 0 ELSE stddev_samp(value) END, 6)
               AS sample_stddev
    FROM events GROUP BY event_type""")
def _(spark, sf):
    stats = mean_and_sample_sd(table(spark, sf, "events"), "event_type", "value")
    return stats.select(
        "event_type", "runs", F.round("mean", 6).alias("mean"),
        F.round("sample_stddev", 6).alias("sample_stddev"),
    )


@query("g20_dedup", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return dedup(lines, ["l_orderkey", "l_linenumber"])


@query("g21_data_quality_profile", """
    WITH lines AS (
        SELECT l_orderkey AS order_id, CAST(l_shipdate AS DATE) AS order_date,
               CASE WHEN l_discount <> 0 THEN l_extendedprice END AS amount,
               l_partkey AS sku, strftime(l_shipdate, '%Y-%m') AS month
        FROM lineitem),
    per_order AS (SELECT order_id, count(*) AS n FROM lines GROUP BY order_id),
    per_group AS (SELECT sku, month, count(*) AS n FROM lines GROUP BY sku, month)
    SELECT 'rows' AS metric, CAST(count(*) AS VARCHAR) AS value FROM lines
    UNION ALL SELECT 'null_amount', CAST(count_if(amount IS NULL) AS VARCHAR) FROM lines
    UNION ALL SELECT 'null_sku', CAST(count_if(sku IS NULL) AS VARCHAR) FROM lines
    UNION ALL SELECT 'first_date', CAST(min(order_date) AS VARCHAR) FROM lines
    UNION ALL SELECT 'last_date', CAST(max(order_date) AS VARCHAR) FROM lines
    UNION ALL SELECT 'repeated_order_ids', CAST(count_if(n > 1) AS VARCHAR) FROM per_order
    UNION ALL SELECT 'largest_order_rows', CAST(max(n) AS VARCHAR) FROM per_order
    UNION ALL SELECT 'largest_group_rows', CAST(max(n) AS VARCHAR) FROM per_group
    UNION ALL SELECT 'large_groups', CAST(count_if(n > 1000) AS VARCHAR) FROM per_group""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.to_date("l_shipdate").alias("order_date"),
        F.when(F.col("l_discount") != 0, F.col("l_extendedprice")).alias("amount"),
        F.col("l_partkey").alias("sku"), month_key("l_shipdate").alias("month"),
    )
    return data_quality_profile(lines, ["amount", "sku"])


# Windows

@query("w1_partition_size", """
    SELECT record_id, sku, month, count(*) OVER (PARTITION BY sku, month) AS group_size
    FROM order_sales""")
def _(spark, sf):
    rows = order_sales(spark, sf).select("record_id", *KEYS)
    return with_group_size(rows, KEYS).select("record_id", *KEYS, "group_size")


@query("w1_partition_size_of_null_keys", """
    SELECT record_id, nullif(sku, 'BUILDING') AS sku,
           CASE WHEN record_id % 3 <> 0 THEN month END AS month,
           count(*) OVER (PARTITION BY nullif(sku, 'BUILDING'),
               CASE WHEN record_id % 3 <> 0 THEN month END) AS group_size
    FROM order_sales""")
def _(spark, sf):
    rows = order_sales(spark, sf).select(
        "record_id", F.nullif("sku", F.lit("BUILDING")).alias("sku"),
        F.when(F.col("record_id") % 3 != 0, F.col("month")).alias("month"),
    )
    return with_group_size(rows, KEYS).select("record_id", *KEYS, "group_size")


@query("w2_nearest_rank", "SELECT * FROM exact_thresholds")
def _(spark, sf):
    return exact_percentiles(amount_histogram(order_base(spark, sf)), KEYS, VALUE)


@query("w2_nearest_rank_by_blocks", "SELECT * FROM exact_thresholds")
def _(spark, sf):
    return percentiles_by_blocks(amount_histogram(order_base(spark, sf)), KEYS, VALUE)


LARGE_RANKS = """
    SELECT l_linestatus, {method}percentile_level, CASE percentile_level
        WHEN 'P80' THEN quantile_disc(l_extendedprice, 0.8)
        ELSE quantile_disc(l_extendedprice, 0.9) END AS threshold
    FROM lineitem, levels GROUP BY l_linestatus, percentile_level"""


@query("w2_large_groups_by_blocks", LARGE_RANKS.format(method="'exact' AS method, "))
def _(spark, sf):
    """Two groups with almost as many distinct values as rows."""
    rows = table(spark, sf, "lineitem")
    histogram = value_histogram(rows, ["l_linestatus"], "l_extendedprice", "l_extendedprice")
    return percentiles_by_blocks(histogram, ["l_linestatus"], "l_extendedprice")


@query("w2_large_groups_by_selection", LARGE_RANKS.format(method=""))
def _(spark, sf):
    rows = table(spark, sf, "lineitem")
    return percentiles_by_selection(rows, ["l_linestatus"], "l_extendedprice", LEVELS, scale=2)


WINDOW_SQL = """
    SELECT state, size, window_date, window_days, row_count, value_count,
           CAST(value_sum AS VARCHAR) AS value_sum,
           CAST(value_square_sum AS VARCHAR) AS value_square_sum
    FROM window_moments"""


@query("w3_trailing_window_aggregate", WINDOW_SQL)
def _(spark, sf):
    return as_text(trailing_window_moments(*sold_days(spark, sf), "state", "order_date", "size"))


@query("w4_difference_array", WINDOW_SQL)
def _(spark, sf):
    return as_text(difference_window_moments(*sold_days(spark, sf), "state", "order_date", "size"))


@query("w4_blocked_difference_array", WINDOW_SQL)
def _(spark, sf):
    return as_text(blocked_window_moments(
        *sold_days(spark, sf), "state", "order_date", "size", block_days=200
    ))


# Ordering

@query("o1_total_order", """
    SELECT state, city, count(*) AS orders FROM order_sales GROUP BY state, city
    ORDER BY state, city""")
def _(spark, sf):
    return count_by(order_sales(spark, sf), ["state", "city"], "orders").orderBy("state", "city")


@query("o2_ordered_top_n", """
    SELECT * FROM differences ORDER BY sku, month, percentile_level, record_id LIMIT 100""")
def _(spark, sf):
    base = order_base(spark, sf)
    deltas = other_deltas(amount_histogram(base, staged=True))
    differences = compare.set_differences(base, deltas, KEYS, VALUE, "record_id")
    return compare.first_rows(differences, SETS, 100)


@query("o3_existence_test", """
    SELECT 'P' AS status, EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P') AS found
    UNION ALL SELECT 'X', EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'X')""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    return existing_values(orders, "o_orderstatus", ["P", "X"]).withColumnRenamed(
        "o_orderstatus", "status"
    )


# Set operations

@query("u1_union_by_name", """
    SELECT sku, month, method, percentile_level, threshold FROM exact_thresholds
    UNION ALL SELECT sku, month, method, percentile_level, threshold FROM approx_thresholds""")
def _(spark, sf):
    base = order_base(spark, sf)
    exact = exact_percentiles(amount_histogram(base), KEYS, VALUE)
    return exact.unionByName(approx_percentiles(base, KEYS, VALUE))


@query("u2_keyed_symmetric_difference", """
    SELECT o_custkey AS customer, 'pending_only' AS difference_side FROM orders
    WHERE o_orderstatus = 'P' AND o_custkey NOT IN (
        SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT')
    UNION ALL
    SELECT o_custkey, 'open_only' FROM orders
    WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' AND o_custkey NOT IN (
        SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    customer = F.col("o_custkey").alias("customer")
    pending = orders.where("o_orderstatus = 'P'").select(customer)
    urgent = orders.where("o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'").select(customer)
    return compare.keyed_difference(pending, urgent, ["customer"], "pending_only", "open_only")
