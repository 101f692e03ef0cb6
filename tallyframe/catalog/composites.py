"""The composite queries, and checks of results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.sales import is_bought
from ..operators import checks
from ..operators.compare import LEVEL, set_difference_counts
from ..operators.moments import ROWS
from ..operators.percentiles import exact_percentiles
from ..operators.running import band_stats_by_blocks
from ..operators.windows import blocked_window_moments, difference_window_moments
from ..plans import percentile_bands as bands
from ..plans.cancelled_rate import conditional_rate_by_city
from ..plans.pipeline_counters import bucket_counters, pipeline_counters, variety_counters
from ..plans.validation import (
    cancelled_rate_contract,
    percentile_bands_contract,
    validate_results,
    variety_median_contract,
    window_winner_contract,
)
from ..plans.variety_median import variety_median, variety_scope_comparison
from ..plans.window_winner import dynamic_window_winner
from ..sources.staging import stage
from ..sources.star_schema import line_sales, order_sales, table
from .registry import query
from .relational import OTHER_LEVELS, SPAN_DAYS, middle_volume, repeated_rows, sold_days, volume_limit

WINNER_SQL = "SELECT * FROM window_winner"


@query("q1_dynamic_window_winner", WINNER_SQL)
def window_winner(spark, sf):
    return dynamic_window_winner(line_sales(spark, sf), limit=volume_limit(spark, sf))


@query("q1_lazy_plan", WINNER_SQL)
def _(spark, sf):
    return dynamic_window_winner(line_sales(spark, sf), limit=volume_limit(spark, sf), staged=False)


@query("q1_by_differences", WINNER_SQL)
def _(spark, sf):
    return dynamic_window_winner(
        line_sales(spark, sf), limit=volume_limit(spark, sf), window_moments=difference_window_moments
    )


@query("q1_by_blocks", WINNER_SQL)
def _(spark, sf):
    return dynamic_window_winner(
        line_sales(spark, sf), limit=volume_limit(spark, sf), window_moments=blocked_window_moments
    )


@query("s4_pipeline_counters", """
    SELECT 'bought_complete_rows' AS counter, count(*) AS rows FROM bought
    WHERE style IN (SELECT style FROM styles)
    UNION ALL SELECT 'non_qualifying_style_rows', count(*) FROM bought
    WHERE style NOT IN (SELECT style FROM styles)
    UNION ALL SELECT 'missing_dimension_rows', 0
    UNION ALL SELECT 'qualifying_styles', count(*) FROM (
        SELECT DISTINCT state, month, style FROM bought WHERE style IN (SELECT style FROM styles))
    UNION ALL SELECT 'state_month_groups', count(*) FROM (
        SELECT DISTINCT state, month FROM bought WHERE style IN (SELECT style FROM styles))
    UNION ALL SELECT 'buckets_emitted', CAST(sum(window_days) AS BIGINT)
    FROM bought JOIN state_days USING (state) WHERE size IS NOT NULL""")
def _(spark, sf):
    daily, days = sold_days(spark, sf)
    return pipeline_counters(
        variety_counters(line_sales(spark, sf)), bucket_counters(daily, days, "state", "size")
    )


@query("q2_variety_median", "SELECT * FROM global_median")
def median(spark, sf):
    return variety_median(line_sales(spark, sf))


@query("q2b_variety_median_in_group", "SELECT * FROM group_median")
def _(spark, sf):
    return variety_median(line_sales(spark, sf), scope="group")


@query("q2c_variety_scope_comparison", """
    SELECT g.state, g.month, g.median_variety, g.qualifying_style_count,
           l.median_variety AS local_median_variety,
           l.qualifying_style_count AS local_qualifying_style_count
    FROM global_median AS g LEFT JOIN group_median AS l
        ON g.state = l.state AND g.month = l.month""")
def _(spark, sf):
    return variety_scope_comparison(line_sales(spark, sf))


RATE_SQL = "SELECT * FROM cancelled_rate ORDER BY state, city"


@query("q3_conditional_rate_by_city", RATE_SQL)
def cancelled_rate(spark, sf):
    return conditional_rate_by_city(order_sales(spark, sf), SPAN_DAYS, unique_records=True)


@query("q3_repeated_records", """
    SELECT state, city, count(*) AS cancelled_standard_orders,
           count_if(coalesce(valid_promotion_count >= 3 AND amount < state_average_amount, FALSE))
               AS qualifying_orders,
           100.0::DOUBLE * count_if(coalesce(valid_promotion_count >= 3
               AND amount < state_average_amount, FALSE)) / count(*) AS percentage
    FROM repeat_rows LEFT JOIN repeat_valid_counts USING (record_id)
         LEFT JOIN repeat_averages USING (state)
    WHERE contains(status, 'CANCELLED') AND service_level = 'STANDARD'
    GROUP BY state, city ORDER BY state, city""")
def _(spark, sf):
    return conditional_rate_by_city(repeated_rows(spark, sf), SPAN_DAYS)


@query("q3_default_of_unique_records", RATE_SQL)
def _(spark, sf):
    return conditional_rate_by_city(order_sales(spark, sf), SPAN_DAYS)


@query("q3_without_broadcast", RATE_SQL)
def _(spark, sf):
    return conditional_rate_by_city(
        order_sales(spark, sf), SPAN_DAYS, unique_records=True, strategy="merge"
    )


STATS = """
    SELECT sku, month, {method} AS method, percentile_level, threshold, qualifying_order_count,
           amount_value_count, round(amount_stddev_pop, 6) AS amount_stddev_pop
    FROM exact_stats"""
# With the default accuracy the approximate thresholds are exact for groups of these sizes.
BOTH_SQL = STATS.format(method="'exact'") + " UNION ALL " + STATS.format(method="'approx'")


def base(spark, sf):
    return bands.sku_month_base(order_sales(spark, sf), unique_records=True)


def rounded(stats):
    return stats.withColumn("amount_stddev_pop", F.round("amount_stddev_pop", 6))


@query("q4_percentile_bands_exact", STATS.format(method="'exact'"))
def _(spark, sf):
    return rounded(bands.percentile_band_stats(base(spark, sf), "exact"))


@query("q4_percentile_bands_approx", STATS.format(method="'approx'"))
def _(spark, sf):
    return rounded(bands.percentile_band_stats(base(spark, sf), "approx"))


@query("q4_percentile_bands_both", BOTH_SQL)
def percentile_stats(spark, sf):
    return rounded(bands.ordered_band_stats(base(spark, sf)))


@query("q4_exact_by_blocks", STATS.format(method="'exact'"))
def _(spark, sf):
    histogram = bands.amount_histogram(base(spark, sf))
    return rounded(band_stats_by_blocks(histogram, bands.KEYS, bands.VALUE))


@query("q4_repeated_records", """
    SELECT r.sku, r.month, 'exact' AS method, percentile_level, threshold,
           count(*) AS qualifying_order_count, count(cents) AS amount_value_count,
           round(CASE WHEN count(*) < 2 OR count(cents) = 0 THEN 0.0::DOUBLE ELSE
               sqrt(CAST(count(cents) * sum(cents * cents) - sum(cents) * sum(cents) AS DOUBLE)
                   / CAST(count(cents) AS DOUBLE) / CAST(count(cents) AS DOUBLE) / 10000.0) END, 6)
               AS amount_stddev_pop
    FROM repeat_base AS r JOIN repeat_thresholds AS t ON r.sku = t.sku AND r.month = t.month
    WHERE promotions >= threshold GROUP BY ALL""")
def _(spark, sf):
    rows = bands.sku_month_base(repeated_rows(spark, sf))
    return rounded(bands.percentile_band_stats(rows, "exact"))


@query("q5_threshold_deltas", """
    SELECT sku, month, percentile_level, a.threshold AS approx_threshold,
           e.threshold AS exact_threshold, a.threshold - e.threshold AS threshold_delta
    FROM approx_thresholds AS a JOIN exact_thresholds AS e
        USING (sku, month, percentile_level)
    ORDER BY sku, month, percentile_level""")
def _(spark, sf):
    return bands.threshold_deltas(base(spark, sf))


@query("q6_set_difference_summary", """
    SELECT sku, month, percentile_level,
           count_if(promotion_count >= a.threshold AND promotion_count < e.threshold)
               AS approx_only_count,
           count_if(promotion_count >= e.threshold AND promotion_count < a.threshold)
               AS exact_only_count
    FROM order_sales JOIN approx_thresholds AS a USING (sku, month)
        JOIN exact_thresholds AS e USING (sku, month, percentile_level)
    GROUP BY sku, month, percentile_level ORDER BY sku, month, percentile_level""")
def _(spark, sf):
    return bands.set_difference_summary(base(spark, sf))


@query("q7_set_difference_examples", """
    SELECT sku, month, percentile_level, record_id,
           CASE WHEN promotion_count >= a.threshold THEN 'approx_only' ELSE 'exact_only' END
               AS difference_side
    FROM order_sales JOIN approx_thresholds AS a USING (sku, month)
        JOIN exact_thresholds AS e USING (sku, month, percentile_level)
    WHERE (promotion_count >= a.threshold) <> (promotion_count >= e.threshold)
    ORDER BY sku, month, percentile_level, record_id LIMIT 100""")
def _(spark, sf):
    return bands.set_difference_examples(base(spark, sf))


# The same three on given thresholds that differ: other levels stand in for the sketch.

def given_thresholds(spark, sf):
    rows = base(spark, sf)
    return rows, {
        "approx": exact_percentiles(bands.row_counts(rows), bands.KEYS, bands.VALUE, OTHER_LEVELS),
    }


@query("q5_threshold_deltas_given", """
    SELECT l.sku, l.month, l.percentile_level, l.threshold AS approx_threshold,
           e.threshold AS exact_threshold, l.threshold - e.threshold AS threshold_delta
    FROM lower_thresholds AS l JOIN exact_thresholds AS e
        ON l.sku = e.sku AND l.month = e.month AND l.percentile_level = e.percentile_level
    ORDER BY l.sku, l.month, l.percentile_level""")
def _(spark, sf):
    rows, given = given_thresholds(spark, sf)
    return bands.threshold_deltas(rows, **given)


@query("q6_set_difference_summary_given", """
    SELECT sku, month, percentile_level, coalesce(approx_only_count, 0) AS approx_only_count,
           coalesce(exact_only_count, 0) AS exact_only_count
    FROM exact_thresholds LEFT JOIN difference_counts USING (sku, month, percentile_level)
    ORDER BY sku, month, percentile_level""")
def _(spark, sf):
    rows, given = given_thresholds(spark, sf)
    return bands.set_difference_summary(rows, **given)


@query("q7_set_difference_examples_given", """
    SELECT * FROM differences ORDER BY sku, month, percentile_level, record_id LIMIT 100""")
def _(spark, sf):
    rows, given = given_thresholds(spark, sf)
    return bands.set_difference_examples(rows, **given)


# With a coarse sketch the values depend on how its partitions merge; what must hold does not.

COARSE = 4


@query("q5_threshold_deltas_coarse", """
    SELECT sku, month, percentile_level, TRUE AS is_a_value, TRUE AS within_rank_error
    FROM exact_thresholds""")
def _(spark, sf):
    """Every approximate threshold is a value of its group, at most N / accuracy ranks off."""
    counts = bands.row_counts(base(spark, sf), staged=True)
    deltas = bands.compare_methods(base(spark, sf), accuracy=COARSE)[0]
    share = F.when(F.col(LEVEL) == "P80", 0.8).otherwise(0.9)
    rows, value, threshold = F.col(ROWS), F.col(bands.VALUE), F.col("approx_threshold")
    ranked = counts.join(deltas, bands.KEYS).groupBy(*bands.KEYS, LEVEL).agg(
        F.max(value == threshold).alias("is_a_value"), F.sum(rows).alias("n"),
        F.sum(F.when(value < threshold, rows).otherwise(0)).alias("below"),
        F.sum(F.when(value <= threshold, rows).otherwise(0)).alias("up_to"),
    )
    error = F.col("n") / COARSE + 1
    return ranked.select(
        *bands.KEYS, LEVEL, "is_a_value",
        ((F.col("below") <= F.col("n") * share + error)
         & (F.col("up_to") >= F.col("n") * share - error)).alias("within_rank_error"),
    )


@query("q6_set_difference_summary_coarse", """
    SELECT sku, month, percentile_level, TRUE AS agrees FROM exact_thresholds""")
def _(spark, sf):
    """The summary counts exactly the rows that the full set of differences holds."""
    _, summary, differences = bands.compare_methods(base(spark, sf), accuracy=COARSE)
    keys = [*bands.KEYS, LEVEL]
    counted = set_difference_counts(differences, keys, "approx_only", "exact_only")
    counted = counted.withColumnsRenamed({"approx_only_count": "a", "exact_only_count": "e"})
    same = (F.coalesce("a", F.lit(0)) == F.col("approx_only_count")) & (
        F.coalesce("e", F.lit(0)) == F.col("exact_only_count")
    )
    return summary.join(counted, keys, "left").select(*keys, same.alias("agrees"))


@query("q7_set_difference_examples_coarse", """
    SELECT sku, month, percentile_level, TRUE AS holds FROM exact_thresholds""")
def _(spark, sf):
    """Every listed row lies between the two thresholds of its group."""
    rows = base(spark, sf)
    deltas, _, differences = bands.compare_methods(rows, accuracy=COARSE)
    keys = [*bands.KEYS, LEVEL]
    values = differences.join(rows.select("record_id", bands.VALUE), "record_id")
    low = F.least("approx_threshold", "exact_threshold")
    high = F.greatest("approx_threshold", "exact_threshold")
    between = (F.col(bands.VALUE) >= low) & (F.col(bands.VALUE) < high)
    return deltas.join(values.drop("difference_side"), keys, "left").groupBy(*keys).agg(
        F.min(F.coalesce(between, F.lit(True))).alias("holds")
    )


@query("q8_group_size_profile", """
    SELECT CAST(sum(n) AS BIGINT) AS valid_rows, count(*) AS group_count,
           max(n) AS maximum_group_rows, count_if(n > 1000) AS groups_above_1000,
           CAST(128 AS BIGINT) AS estimated_bytes_per_row,
           max(n) * 128 AS estimated_maximum_group_bytes
    FROM (SELECT count(*) AS n FROM order_sales GROUP BY sku, month)""")
def _(spark, sf):
    return bands.sku_month_profile(base(spark, sf))


# Checks

@query("v1_schema", """
    SELECT * FROM (VALUES ('cancelled_rate', 'schema', 'column 2'),
        ('cancelled_rate', 'schema', 'column 3')) AS v(result, rule, row_key)
    UNION ALL SELECT 'cancelled_rate', 'percentage', state || '|' || city FROM cancelled_rate""")
def _(spark, sf):
    """Columns in another order give schema violations only; a wrong value is found by row."""
    rates, contract = cancelled_rate(spark, sf), cancelled_rate_contract()
    swapped = rates.select(
        "state", "city", "qualifying_orders", "cancelled_standard_orders", "percentage"
    )
    raised = rates.withColumn("percentage", F.col("percentage") + 101)
    return checks.check_all([(swapped, contract), (raised, contract)])


@query("v2_unique_key", """
    SELECT 'cancelled_rate' AS result, 'unique_key' AS rule, n_name || '|' || c_mktsegment
        AS row_key
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name, c_mktsegment HAVING count(*) <> 1""")
def _(spark, sf):
    return checks.duplicate_keys(order_sales(spark, sf), cancelled_rate_contract())


# Results with planted faults, derived from the line items.

@query("v3_row_rules_cancelled_rate", """
    SELECT 'cancelled_rate' AS result, rule, CAST(l_orderkey AS VARCHAR) || '|'
        || CAST(l_partkey AS VARCHAR) AS row_key
    FROM lineitem, (SELECT unnest(['cancelled_standard_orders', 'qualifying_orders',
        'percentage']) AS rule)
    WHERE CASE rule WHEN 'cancelled_standard_orders' THEN l_linenumber - 2 <= 0
        WHEN 'qualifying_orders' THEN CAST(l_discount * 100 AS BIGINT) > l_linenumber - 2
        ELSE l_tax > 0.05 OR l_returnflag = 'N' END""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("state"),
        F.col("l_partkey").cast("string").alias("city"),
        (F.col("l_linenumber").cast("bigint") - 2).alias("cancelled_standard_orders"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("qualifying_orders"),
        F.when(F.col("l_returnflag") == "N", F.lit(float("nan")))
        .when(F.col("l_tax") > 0.05, 100.5).otherwise(F.col("l_tax")).alias("percentage"),
    )
    return checks.broken_rules(rows, cancelled_rate_contract())


@query("v3_row_rules_window_winner", """
    SELECT 'window_winner' AS result, rule, CAST(o_orderkey AS VARCHAR) || '|'
        || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS row_key
    FROM orders, (SELECT unnest(['window_days', 'frequency', 'population_variance']) AS rule)
    WHERE CASE rule WHEN 'window_days' THEN o_orderkey % 3 = 0
        WHEN 'frequency' THEN o_custkey % 5 = 0
        ELSE o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_totalprice > 200000) END""")
def _(spark, sf):
    price = F.col("o_totalprice")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("state"),
        F.to_date("o_orderdate").alias("window_date"),
        F.element_at(F.array(F.lit(7), F.lit(5), F.lit(10)),
                     (F.col("o_orderkey") % 3 + 1).cast("int")).alias("window_days"),
        (F.col("o_custkey") % 5).alias("frequency"),
        F.when(F.col("o_orderstatus") == "P", -price)
        .when(F.col("o_orderstatus") == "F", F.when(price > 200000, F.lit(float("inf")))
              .otherwise(price)).alias("population_variance"),
    )
    return checks.broken_rules(rows, window_winner_contract())


@query("v3_row_rules_variety_median", """
    SELECT 'variety_median' AS result, rule, CAST(p_partkey AS VARCHAR) || '|'
        || CASE WHEN p_size % 2 = 0 THEN '1998-05' ELSE '1998-5' END AS row_key
    FROM part, (SELECT unnest(['month', 'median_variety', 'qualifying_style_count']) AS rule)
    WHERE CASE rule WHEN 'month' THEN p_size % 2 = 1 WHEN 'median_variety' THEN p_size / 10 < 1
        ELSE p_partkey % 4 = 0 END""")
def _(spark, sf):
    size, key = F.col("p_size"), F.col("p_partkey")
    rows = table(spark, sf, "part").select(
        key.cast("string").alias("state"),
        F.when(size % 2 == 0, "1998-05").otherwise("1998-5").alias("month"),
        (size / 10).alias("median_variety"), (key % 4).alias("qualifying_style_count"),
    )
    return checks.broken_rules(rows, variety_median_contract())


@query("v3_row_rules_percentile_bands", """
    SELECT 'percentile_bands' AS result, rule, concat_ws('|', sku, month,
        CASE WHEN record_id % 3 = 0 THEN 'guess' ELSE 'exact' END,
        CASE WHEN record_id % 2 = 0 THEN 'P80' ELSE 'P70' END) AS row_key
    FROM order_sales, (SELECT unnest(['method', 'percentile_level', 'threshold',
        'qualifying_order_count', 'amount_value_count', 'amount_stddev_pop']) AS rule)
    WHERE CASE rule WHEN 'method' THEN record_id % 3 = 0
        WHEN 'percentile_level' THEN record_id % 2 = 1
        WHEN 'threshold' THEN promotion_count < 2 WHEN 'qualifying_order_count'
            THEN promotion_count <= 0 WHEN 'amount_value_count' THEN promotion_count < 1
        ELSE amount IS NULL END""")
def _(spark, sf):
    key = F.col("record_id")
    rows = base(spark, sf).select(
        "sku", "month", F.when(key % 3 == 0, "guess").otherwise("exact").alias("method"),
        F.when(key % 2 == 0, "P80").otherwise("P70").alias(LEVEL),
        (F.col("promotion_count") - 2).cast("double").alias("threshold"),
        F.col("promotion_count").alias("qualifying_order_count"),
        F.lit(1).cast("bigint").alias("amount_value_count"),
        F.col("amount").alias("amount_stddev_pop"),
    )
    return checks.broken_rules(rows, percentile_bands_contract())


@query("v4_multiplicity", """
    SELECT 'percentile_bands' AS result, 'multiplicity' AS rule, sku || '|' || month AS row_key
    FROM order_sales GROUP BY sku, month HAVING count(*) <> 4""")
def _(spark, sf):
    return checks.wrong_multiplicity(base(spark, sf), percentile_bands_contract())


@query("v5_check_all", """
    SELECT 'cancelled_rate' AS result, 'unique_key' AS rule, state || '|' || city AS row_key
    FROM cancelled_rate
    UNION ALL
    SELECT 'percentile_bands', 'multiplicity', sku || '|' || month
    FROM exact_thresholds WHERE percentile_level = 'P80'""")
def _(spark, sf):
    rates = cancelled_rate(spark, sf)
    exact = bands.percentile_band_stats(base(spark, sf), "exact")
    return checks.check_all([
        (rates.unionByName(rates), cancelled_rate_contract()),
        (exact, percentile_bands_contract()),
    ])


@query("q10_validate_results", """
    SELECT 'window_winner' AS result, 'unique_key' AS rule,
           state || '|' || CAST(window_date AS VARCHAR) AS row_key FROM window_winner
    UNION ALL SELECT 'variety_median', 'month', state || '|' || replace(month, '-', '/')
    FROM global_median
    UNION ALL SELECT * FROM (VALUES ('cancelled_rate', 'schema', 'column 2'),
        ('cancelled_rate', 'schema', 'column 3'))
    UNION ALL SELECT 'percentile_bands', 'multiplicity', sku || '|' || month
    FROM exact_thresholds WHERE percentile_level = 'P80'""")
def _(spark, sf):
    """All four results at once, each with a planted fault of another kind.

    The sale rows that they share are joined and written once, not anew for each result.
    """
    sold = line_sales(spark, sf).where(is_bought("status", "qty"))
    lines = stage(sold, "sold-lines")
    orders = stage(order_sales(spark, sf).drop("order_id"), "order-sales")
    winners = stage(dynamic_window_winner(lines, limit=middle_volume(lines)), "winners")
    rates = conditional_rate_by_city(orders, SPAN_DAYS, unique_records=True)
    swapped = rates.select(
        "state", "city", "qualifying_orders", "cancelled_standard_orders", "percentage"
    )
    return validate_results(
        winners.unionByName(winners),
        variety_median(lines).withColumn("month", F.replace("month", F.lit("-"), F.lit("/"))),
        swapped,
        bands.percentile_band_stats(bands.sku_month_base(orders, unique_records=True), "exact"),
    )
