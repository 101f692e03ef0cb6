"""Column expressions applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import token_array, token_count
from ..functions.sales import below_reference_flag, is_at_least_xxl, is_bought, size_rank
from ..functions.text import (
    clean_text,
    month_key,
    normalize_dimension,
    normalized_equals,
    status_contains,
    strict_date,
    to_finite_double,
    to_long,
)
from ..operators.keys import label_columns, missing_key_counts, require_keys, zero_fill
from ..operators.percentiles import percentile_rows
from ..operators.tokens import tokens
from ..operators.windows import future_buckets
from ..plans.cancelled_rate import state_averages
from ..sources.star_schema import line_sales, order_promotions, order_sales, table
from .registry import query

# Part names with stray blanks and mixed case; every seventh one is blank.
MESSY_PART_SQL = r"""
    SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN E' \t ' ELSE
        E'\t ' || p_name || E' \n  ' || lower(p_type) || ' ' END AS raw FROM part"""


def messy_parts(spark, sf):
    raw = F.when(F.col("p_partkey") % 7 == 0, " \t ").otherwise(
        F.concat(F.lit("\t "), "p_name", F.lit(" \n  "), F.lower("p_type"), F.lit(" "))
    )
    return table(spark, sf, "part").select("p_partkey", raw.alias("raw"))


@query("p1_normalize_dimension", f"""
    SELECT p_partkey, nullif(upper(trim(regexp_replace(raw, '\\s+', ' ', 'g'))), '') AS label
    FROM ({MESSY_PART_SQL})""")
def _(spark, sf):
    return messy_parts(spark, sf).select("p_partkey", normalize_dimension("raw").alias("label"))


@query("p2_clean_text", f"""
    SELECT p_partkey, nullif(regexp_replace(raw, '^\\s+|\\s+$', '', 'g'), '') AS label
    FROM ({MESSY_PART_SQL})""")
def _(spark, sf):
    return messy_parts(spark, sf).select("p_partkey", clean_text("raw").alias("label"))


# Dates as text: one in four is impossible, badly padded or written with a long year.
@query("p3_strict_date", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN
        make_date(2000 + year(o_orderdate) % 100, month(o_orderdate), day(o_orderdate)) END
        AS order_date
    FROM orders""")
def _(spark, sf):
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    raw = (
        F.when(key % 4 == 0, F.concat(F.lit("\t"), F.date_format(date, "MM-dd-yy"), F.lit(" ")))
        .when(key % 4 == 1, F.date_format(date, "'02-30-'yy"))
        .when(key % 4 == 2, F.date_format(date, "MM-dd-yyyy"))
        .otherwise(F.lit("4-5-22"))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", strict_date(raw).alias("order_date")
    )


@query("p4_month_key", """
    SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m') AS month
    FROM lineitem""")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        month_key(F.to_date("l_shipdate")).alias("month"),
    )


@query("p5_numeric_parse", """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS whole_number,
           CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice END AS finite_number
    FROM orders""")
def _(spark, sf):
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("string")
    whole = (
        F.when(key % 3 == 0, F.concat(F.lit(" +"), F.col("o_custkey").cast("string"), F.lit("\t")))
        .when(key % 3 == 1, price).otherwise("x")
    )
    number = (
        F.when(key % 4 == 0, F.concat(F.lit(" "), price)).when(key % 4 == 1, "NaN")
        .when(key % 4 == 2, "-Infinity").otherwise("12,5")
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", to_long(whole).alias("whole_number"),
        to_finite_double(number).alias("finite_number"),
    )


@query("p6_is_bought", """
    SELECT status, qty, qty > 0 AND contains(lower(status), 'shipped') AS is_bought,
           count(*) AS rows
    FROM line_sales GROUP BY ALL""")
def _(spark, sf):
    rows = line_sales(spark, sf).select("status", "qty", is_bought("status", "qty").alias("is_bought"))
    return rows.groupBy("status", "qty", "is_bought").agg(F.count(F.lit(1)).alias("rows"))


@query("p7_normalized_equals", f"""
    SELECT p_partkey,
           coalesce(upper(trim(regexp_replace(raw, '\\s+', ' ', 'g'))) = 'RED WIDGET ECONOMY',
               FALSE) AS is_red_widget
    FROM ({MESSY_PART_SQL})""")
def _(spark, sf):
    return messy_parts(spark, sf).select(
        "p_partkey", normalized_equals("raw", "red widget economy").alias("is_red_widget")
    )


@query("p8_status_contains", """
    SELECT record_id, contains(status, 'CANCEL') AS is_cancelled FROM order_sales""")
def _(spark, sf):
    return order_sales(spark, sf).select(
        "record_id", status_contains("status", "cancel").alias("is_cancelled")
    )


# Sizes of many spellings: numbered, repeated X, with blanks, and unknown ones.
SIZE_SQL = """
    SELECT p_partkey, p_size, CASE p_size % 7
        WHEN 0 THEN CAST(p_size AS VARCHAR) || 'XL' WHEN 1 THEN repeat('x', p_size // 7 + 1) || 'l'
        WHEN 2 THEN ' 3 xl' WHEN 3 THEN 'M' WHEN 4 THEN 'Free' WHEN 5 THEN 'XS'
        ELSE '1XL' END AS raw
    FROM part"""


def spelled_sizes(spark, sf):
    size = F.col("p_size")
    raw = (
        F.when(size % 7 == 0, F.concat(size.cast("string"), F.lit("XL")))
        .when(size % 7 == 1, F.concat(
            F.repeat(F.lit("x"), F.floor(size / 7).cast("int") + 1), F.lit("l")))
        .when(size % 7 == 2, " 3 xl").when(size % 7 == 3, "M").when(size % 7 == 4, "Free")
        .when(size % 7 == 5, "XS").otherwise("1XL")
    )
    return table(spark, sf, "part").select("p_partkey", "p_size", raw.alias("raw"))


@query("p9_is_at_least_xxl", f"""
    SELECT p_partkey, raw, CASE p_size % 7
        WHEN 0 THEN p_size >= 2 WHEN 1 THEN p_size // 7 + 1 >= 2 WHEN 2 THEN TRUE
        ELSE FALSE END AS is_large
    FROM ({SIZE_SQL})""")
def _(spark, sf):
    return spelled_sizes(spark, sf).select(
        "p_partkey", "raw", is_at_least_xxl("raw").alias("is_large")
    )


@query("p10_size_rank", f"""
    SELECT p_partkey, raw, CASE p_size % 7
        WHEN 0 THEN CASE WHEN p_size > 0 THEN CAST(p_size AS BIGINT) + 4 END
        WHEN 1 THEN CAST(p_size // 7 + 1 + 4 AS BIGINT)
        WHEN 2 THEN 7 WHEN 3 THEN 3 WHEN 5 THEN 1 WHEN 6 THEN 5 END AS size_rank
    FROM ({SIZE_SQL})""")
def _(spark, sf):
    return spelled_sizes(spark, sf).select("p_partkey", "raw", size_rank("raw").alias("size_rank"))


@query("p11_require_keys", """
    SELECT record_id, amount, promotion_ids_raw FROM order_sales
    WHERE amount IS NOT NULL AND promotion_ids_raw IS NOT NULL""")
def _(spark, sf):
    return require_keys(order_sales(spark, sf), ["amount", "promotion_ids_raw"]).select(
        "record_id", "amount", "promotion_ids_raw"
    )


@query("p11_missing_key_counts", """
    SELECT count_if(amount IS NOT NULL AND promotion_ids_raw IS NOT NULL) AS kept_rows,
           count_if(amount IS NULL OR promotion_ids_raw IS NULL) AS dropped_rows
    FROM order_sales""")
def _(spark, sf):
    return missing_key_counts(order_sales(spark, sf), ["amount", "promotion_ids_raw"])


@query("p12_zero_fill", """
    SELECT c_custkey, coalesce(order_count, 0) AS order_count
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS order_count FROM orders
        WHERE o_orderstatus = 'P' GROUP BY o_custkey) ON c_custkey = o_custkey""")
def _(spark, sf):
    counts = table(spark, sf, "orders").where("o_orderstatus = 'P'").groupBy(
        F.col("o_custkey").alias("c_custkey")
    ).agg(F.count(F.lit(1)).alias("order_count"))
    joined = table(spark, sf, "customer").select("c_custkey").join(counts, "c_custkey", "left")
    return zero_fill(joined, ["order_count"])


@query("p13_label_columns", """
    SELECT l_orderkey, l_linenumber, l_partkey, 'line' AS method,
           CASE WHEN l_linenumber = 1 THEN 'P80' ELSE 'P90' END AS percentile_level
    FROM lineitem""")
def _(spark, sf):
    return label_columns(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"),
        method="line",
        percentile_level=F.when(F.col("l_linenumber") == 1, "P80").otherwise("P90"),
    )


@query("p14_project_rename", """
    SELECT month, state AS region, record_id AS id FROM order_sales""")
def _(spark, sf):
    return order_sales(spark, sf).select(
        "month", F.col("state").alias("region"), F.col("record_id").alias("id")
    )


@query("p15_below_reference_flag", """
    SELECT record_id, coalesce(promotion_count >= 3 AND amount < state_average_amount, FALSE)
        AS is_qualifying
    FROM order_sales LEFT JOIN state_averages USING (state)""")
def _(spark, sf):
    sales = order_sales(spark, sf)
    counted = sales.withColumn("promotion_count", token_count("promotion_ids_raw"))
    joined = counted.join(state_averages(sales), "state", "left")
    return joined.select("record_id", below_reference_flag(
        "promotion_count", "amount", "state_average_amount"
    ).alias("is_qualifying"))


@query("a1_token_array", """
    SELECT o_orderkey AS record_id, coalesce(tokens, '') AS tokens,
           coalesce(token_count, 0) AS token_count
    FROM orders LEFT JOIN (
        SELECT record_id, string_agg(promotion_id, '|' ORDER BY promotion_id) AS tokens,
               count(*) AS token_count
        FROM order_tokens GROUP BY record_id) AS t ON o_orderkey = t.record_id""")
def _(spark, sf):
    array = token_array("promotion_ids_raw")
    return order_sales(spark, sf).select(
        "record_id", F.concat_ws("|", array).alias("tokens"),
        token_count("promotion_ids_raw").alias("token_count"),
    )


@query("a2_tokens", """
    SELECT record_id, CAST(o_orderdate AS DATE) AS order_date, promotion_id
    FROM order_tokens JOIN orders ON record_id = o_orderkey""")
def _(spark, sf):
    return tokens(order_sales(spark, sf))


@query("a2_tokens_repeated_records", """
    SELECT DISTINCT l_partkey AS record_id, 'T' || CAST(l_linenumber AS VARCHAR) AS promotion_id
    FROM lineitem""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("record_id"), F.to_date("l_shipdate").alias("order_date"),
        F.concat(F.lit("T"), F.col("l_linenumber").cast("string"), F.lit(", ,T"),
                 F.col("l_linenumber").cast("string")).alias("promotion_ids_raw"),
    )
    return tokens(lines, unique_records=False).drop("order_date")


@query("a3_percentile_rows", """
    SELECT state, percentile_level, CAST(threshold AS DOUBLE) AS threshold FROM (
        SELECT state, unnest(['P80', 'P90']) AS percentile_level,
               unnest([min(promotion_count), max(promotion_count)]) AS threshold
        FROM order_sales GROUP BY state)""")
def _(spark, sf):
    counts = order_promotions(spark, sf).select(
        "record_id", token_count("promotion_ids_raw").alias("n")
    )
    sales = order_sales(spark, sf).select("record_id", "state").join(counts, "record_id", "left")
    n = F.coalesce("n", F.lit(0))
    arrays = sales.groupBy("state").agg(F.array(F.min(n), F.max(n)).alias("thresholds"))
    return percentile_rows(arrays, ["state"], "thresholds")


@query("a4_future_buckets", """
    SELECT o_orderkey, CAST(unnest(generate_series(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY,
        CAST(o_orderdate AS DATE) + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS DATE) AS window_date
    FROM orders""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_date")
    )
    return future_buckets(orders, "order_date", 3).drop("order_date")
