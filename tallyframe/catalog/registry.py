"""The register itself and the SQL views shared by the queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

# The SQL counterparts of ``line_sales`` and ``order_sales``, and of common steps on them.
VIEWS = {
    "line_sales": """
        SELECT n_name AS state, CAST(l_shipdate AS DATE) AS order_date,
               CASE l_returnflag WHEN 'N' THEN 'Cancelled'
                    WHEN 'R' THEN ' Shipped -  Returned to Seller' ELSE 'shipped' END AS status,
               CAST(l_quantity AS BIGINT) - 2 AS qty,
               CASE WHEN l_discount <> 0 THEN l_extendedprice END AS amount,
               p_brand || '-' || p_type AS style, CAST(l_partkey AS VARCHAR) AS sku,
               CASE WHEN p_size = 50 THEN '3XL' WHEN p_size = 49 THEN 'xxl'
                    WHEN p_size % 4 = 0 THEN 'S' WHEN p_size % 4 = 1 THEN 'M'
                    WHEN p_size % 4 = 2 THEN 'L' ELSE 'XL' END AS size
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
             JOIN part ON l_partkey = p_partkey""",
    "bought": """
        SELECT upper(state) AS state, order_date, strftime(order_date, '%Y-%m') AS month,
               upper(style) AS style, sku, upper(size) AS size, amount,
               CAST(round(amount * 100) AS HUGEINT) AS cents
        FROM line_sales WHERE qty > 0 AND contains(lower(status), 'shipped')""",
    "order_tokens": """
        SELECT DISTINCT l_orderkey AS record_id,
               'PROMO-' || CAST(l_partkey % 500 AS VARCHAR) AS promotion_id
        FROM lineitem WHERE l_discount > 0.03""",
    "order_sales": """
        SELECT o_orderkey AS record_id, 'O-' || CAST(o_orderkey AS VARCHAR) AS order_id,
               CAST(o_orderdate AS DATE) AS order_date,
               strftime(o_orderdate, '%Y-%m') AS month,
               CASE o_orderstatus WHEN 'P' THEN 'CANCELLED' WHEN 'F' THEN 'SHIPPED'
                    ELSE 'PENDING' END AS status,
               CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 'STANDARD'
                    ELSE 'EXPEDITED' END AS service_level,
               CASE WHEN c_custkey % 2 = 0 THEN 'MERCHANT' ELSE 'AMAZON' END AS fulfilment,
               CASE WHEN o_orderstatus = 'F' THEN 'SHIPPED' ELSE 'UNSHIPPED' END
                   AS courier_status,
               n_name AS state, c_mktsegment AS city, c_mktsegment AS sku,
               CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS amount,
               CASE WHEN o_orderkey % 17 <> 0
                    THEN CAST(round(o_totalprice * 100) AS HUGEINT) END AS cents,
               coalesce(token_count, 0) AS promotion_count, promotion_ids_raw
        FROM orders JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey
             LEFT JOIN (
                 SELECT record_id, count(*) AS token_count,
                        string_agg(promotion_id, ', ' ORDER BY promotion_id)
                            || ',  , ' || min(promotion_id) AS promotion_ids_raw
                 FROM order_tokens GROUP BY record_id) AS t ON o_orderkey = t.record_id""",
    "state_days": """
        SELECT state, CAST(CASE WHEN volume > (min(volume) OVER () + max(volume) OVER ()) // 2
                           THEN 5 ELSE 10 END AS INTEGER) AS window_days
        FROM (SELECT state, count(*) AS volume FROM bought GROUP BY state)""",
    # A row per line item, so that record ids repeat with other tokens in each row.
    "repeat_rows": """
        SELECT order_sales.*, l_partkey % 500 AS first_token, l_suppkey % 50 AS second_token
        FROM order_sales JOIN lineitem ON record_id = l_orderkey""",
    "repeat_tokens": """
        SELECT DISTINCT record_id, order_date, 'PROMO-' || CAST(token AS VARCHAR) AS promotion_id
        FROM (SELECT record_id, order_date, unnest([first_token, second_token]) AS token
              FROM repeat_rows)""",
    "repeat_valid_counts": """
        SELECT record_id, count(*) AS valid_promotion_count FROM repeat_tokens
        WHERE promotion_id IN (SELECT promotion_id FROM repeat_tokens GROUP BY promotion_id
            HAVING CAST(max(order_date) - min(order_date) AS INTEGER) >= 2350)
        GROUP BY record_id""",
    "repeat_counts": """
        SELECT record_id, count(*) AS promotions FROM repeat_tokens GROUP BY record_id""",
    "repeat_averages": """
        SELECT state, CAST(sum(cents) AS DOUBLE) / count(cents) / 100.0 AS state_average_amount
        FROM repeat_rows
        WHERE fulfilment = 'MERCHANT' AND courier_status = 'SHIPPED' AND cents IS NOT NULL
        GROUP BY state""",
    "window_rows": """
        SELECT state, size, cents, window_days,
               CAST(unnest(generate_series(order_date + INTERVAL 1 DAY,
                   order_date + to_days(window_days), INTERVAL 1 DAY)) AS DATE) AS window_date
        FROM bought JOIN state_days USING (state) WHERE size IS NOT NULL""",
    "window_moments": """
        SELECT state, size, window_date, window_days, count(*) AS row_count,
               count(cents) AS value_count, coalesce(sum(cents), 0) AS value_sum,
               coalesce(sum(cents * cents), 0) AS value_square_sum
        FROM window_rows GROUP BY ALL""",
    "window_candidates": """
        SELECT state, size, window_date, window_days, row_count AS frequency,
               CASE WHEN value_count > 0 THEN
                   CAST(value_count * value_square_sum - value_sum * value_sum AS DOUBLE)
                   / CAST(value_count AS DOUBLE) / CAST(value_count AS DOUBLE) / 10000.0 END
                   AS population_variance
        FROM window_moments""",
    "window_winner": """
        SELECT state, window_date, window_days, size AS winning_size, frequency,
               population_variance
        FROM window_candidates
        QUALIFY row_number() OVER (PARTITION BY state, window_date
            ORDER BY frequency DESC, population_variance ASC NULLS LAST, size) = 1""",
    "styles": """
        SELECT DISTINCT style FROM bought
        WHERE regexp_matches(size, '^([2-9]|[1-9][0-9]+)XL$|^X{2,}L$')""",
    "global_median": """
        SELECT state, month, median(variety) AS median_variety,
               count(*) AS qualifying_style_count
        FROM (SELECT state, month, style, count(DISTINCT sku) AS variety FROM bought
              WHERE style IN (SELECT style FROM styles) GROUP BY ALL)
        GROUP BY ALL""",
    "group_median": """
        SELECT state, month, median(variety) AS median_variety,
               count(*) AS qualifying_style_count
        FROM (SELECT state, month, style, count(DISTINCT sku) AS variety FROM bought
              GROUP BY ALL
              HAVING bool_or(regexp_matches(size, '^([2-9]|[1-9][0-9]+)XL$|^X{2,}L$')))
        GROUP BY ALL""",
    "lifespans": """
        SELECT promotion_id, min(order_date) AS first_date, max(order_date) AS last_date,
               count(DISTINCT record_id) AS promoted_record_count,
               CAST(max(order_date) - min(order_date) AS INTEGER) AS span_days
        FROM order_tokens JOIN order_sales USING (record_id) GROUP BY promotion_id""",
    "valid_counts": """
        SELECT record_id, count(*) AS valid_promotion_count
        FROM order_tokens
        WHERE promotion_id IN (SELECT promotion_id FROM lifespans WHERE span_days >= 2350)
        GROUP BY record_id""",
    "state_averages": """
        SELECT state, CAST(sum(cents) AS DOUBLE) / count(cents) / 100.0 AS state_average_amount
        FROM order_sales
        WHERE fulfilment = 'MERCHANT' AND courier_status = 'SHIPPED' AND cents IS NOT NULL
        GROUP BY state""",
    "enriched": """
        SELECT o.record_id, o.state, o.city, o.amount,
               coalesce(valid_promotion_count, 0) AS valid_promotion_count,
               state_average_amount,
               coalesce(valid_promotion_count >= 3 AND o.amount < state_average_amount, FALSE)
                   AS is_qualifying
        FROM order_sales AS o LEFT JOIN valid_counts USING (record_id)
             LEFT JOIN state_averages USING (state)
        WHERE contains(status, 'CANCELLED') AND service_level = 'STANDARD'""",
    "cancelled_rate": """
        SELECT state, city, count(*) AS cancelled_standard_orders,
               count_if(is_qualifying) AS qualifying_orders,
               100.0::DOUBLE * count_if(is_qualifying) / count(*) AS percentage
        FROM enriched GROUP BY state, city""",
    "levels": """
        SELECT * FROM (VALUES ('P80', 0.8::DOUBLE), ('P90', 0.9::DOUBLE))
            AS v(percentile_level, p)""",
    "repeat_base": """
        SELECT sku, month, promotions, cents, count(*) OVER (PARTITION BY sku, month) AS n,
               row_number() OVER (PARTITION BY sku, month ORDER BY promotions) AS rn
        FROM repeat_rows JOIN repeat_counts USING (record_id)""",
    "repeat_thresholds": """
        SELECT sku, month, percentile_level, CAST(promotions AS DOUBLE) AS threshold
        FROM repeat_base, levels WHERE rn = CAST(ceil(CAST(n AS DOUBLE) * p) AS BIGINT)""",
    "exact_thresholds": """
        SELECT sku, month, 'exact' AS method, percentile_level,
               CAST(promotion_count AS DOUBLE) AS threshold
        FROM (SELECT sku, month, promotion_count,
                     count(*) OVER (PARTITION BY sku, month) AS n,
                     row_number() OVER (PARTITION BY sku, month
                         ORDER BY promotion_count, record_id) AS rn
              FROM order_sales), levels
        WHERE rn = CAST(ceil(CAST(n AS DOUBLE) * p) AS BIGINT)""",
    "approx_thresholds": """
        SELECT sku, month, 'approx' AS method, 'P80' AS percentile_level,
               CAST(quantile_disc(promotion_count, 0.8) AS DOUBLE) AS threshold
        FROM order_sales GROUP BY sku, month
        UNION ALL
        SELECT sku, month, 'approx', 'P90',
               CAST(quantile_disc(promotion_count, 0.9) AS DOUBLE)
        FROM order_sales GROUP BY sku, month""",
    "lower_thresholds": """
        SELECT sku, month, 'exact' AS method, percentile_level,
               CAST(promotion_count AS DOUBLE) AS threshold
        FROM (SELECT sku, month, promotion_count,
                     count(*) OVER (PARTITION BY sku, month) AS n,
                     row_number() OVER (PARTITION BY sku, month
                         ORDER BY promotion_count, record_id) AS rn
              FROM order_sales),
             (VALUES ('P80', 0.5::DOUBLE), ('P90', 0.95::DOUBLE)) AS v(percentile_level, p)
        WHERE rn = CAST(ceil(CAST(n AS DOUBLE) * p) AS BIGINT)""",
    "histogram": """
        SELECT sku, month, promotion_count, count(*) AS row_count, count(cents) AS value_count,
               coalesce(sum(cents), 0) AS value_sum,
               coalesce(sum(cents * cents), 0) AS value_square_sum
        FROM order_sales GROUP BY ALL""",
    "exact_stats": """
        SELECT o.sku, o.month, method, percentile_level, threshold,
               count(*) AS qualifying_order_count, count(cents) AS amount_value_count,
               CASE WHEN count(*) < 2 OR count(cents) = 0 THEN 0.0::DOUBLE ELSE
                   sqrt(CAST(count(cents) * sum(cents * cents) - sum(cents) * sum(cents)
                       AS DOUBLE) / CAST(count(cents) AS DOUBLE) / CAST(count(cents) AS DOUBLE)
                       / 10000.0) END AS amount_stddev_pop
        FROM order_sales AS o JOIN exact_thresholds AS t ON o.sku = t.sku AND o.month = t.month
        WHERE promotion_count >= threshold
        GROUP BY ALL""",
    "low_qualifying": """
        SELECT o.sku, o.month, percentile_level, record_id
        FROM order_sales AS o JOIN lower_thresholds AS t ON o.sku = t.sku AND o.month = t.month
        WHERE promotion_count >= threshold""",
    "exact_qualifying": """
        SELECT o.sku, o.month, percentile_level, record_id
        FROM order_sales AS o JOIN exact_thresholds AS t ON o.sku = t.sku AND o.month = t.month
        WHERE promotion_count >= threshold""",
    "differences": """
        SELECT *, 'approx_only' AS difference_side FROM low_qualifying AS l
        WHERE NOT EXISTS (SELECT 1 FROM exact_qualifying AS e
            WHERE (l.sku, l.month, l.percentile_level, l.record_id)
                = (e.sku, e.month, e.percentile_level, e.record_id))
        UNION ALL
        SELECT *, 'exact_only' AS difference_side FROM exact_qualifying AS e
        WHERE NOT EXISTS (SELECT 1 FROM low_qualifying AS l
            WHERE (l.sku, l.month, l.percentile_level, l.record_id)
                = (e.sku, e.month, e.percentile_level, e.record_id))""",
    "difference_counts": """
        SELECT sku, month, percentile_level,
               count_if(difference_side = 'approx_only') AS approx_only_count,
               count_if(difference_side = 'exact_only') AS exact_only_count
        FROM differences GROUP BY ALL""",
    # The lines of ``sales_lines``: what becomes of each order, by its key alone.
    "line_defects": """
        SELECT *, record_id % 23 AS defect, record_id % 5 - 1 AS qty FROM order_sales""",
    "line_outcomes": """
        SELECT *, CASE
            WHEN defect = 1 THEN 'csv' WHEN defect = 2 THEN 'index'
            WHEN defect = 3 THEN 'Order ID' WHEN defect = 4 THEN 'Date'
            WHEN defect = 5 THEN 'Status' WHEN defect = 6 THEN 'Fulfilment'
            WHEN defect = 7 THEN 'ship-service-level' WHEN defect = 8 THEN 'Qty'
            WHEN defect = 9 THEN 'Amount' WHEN defect IN (11, 12) THEN 'csv' END
            AS reject_field,
            CASE WHEN defect IN (1, 11, 12) THEN 'structure'
                 WHEN defect IN (3, 5, 6, 7) THEN 'missing'
                 WHEN defect IN (2, 4, 8, 9) THEN 'invalid' END AS reject_reason
        FROM line_defects""",
    "valid_lines": """
        SELECT record_id, order_id,
               make_date(2000 + year(order_date) % 100, month(order_date), day(order_date))
                   AS order_date,
               status, fulfilment, service_level, sku, qty, amount, city,
               CASE WHEN defect <> 10 THEN state END AS state, promotion_count,
               strftime(make_date(2000 + year(order_date) % 100, month(order_date),
                   day(order_date)), '%Y-%m') AS month
        FROM line_outcomes WHERE reject_field IS NULL""",
    "outcome_counts": """
        SELECT outcome, count(*) AS rows FROM (
            SELECT unnest([outcome, 'rows_read']) AS outcome FROM (
                SELECT CASE WHEN reject_field IS NOT NULL THEN 'rejected:' || reject_field
                            WHEN qty <= 0 OR status <> 'SHIPPED' THEN 'not_bought'
                            WHEN defect = 10 THEN 'missing_key' ELSE 'accepted' END AS outcome
                FROM line_outcomes
                UNION ALL SELECT 'header' FROM nation))
        GROUP BY outcome""",
}


def _with_views(sql: str) -> str:
    """Prefix the query with the views it uses, directly or through other views."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and _mentions(text, name):
                needed.add(name)
                visit(VIEWS[name])

    visit(sql)
    if not needed:
        return sql
    views = [f"{name} AS ({VIEWS[name].strip()})" for name in VIEWS if name in needed]
    return "WITH " + ",\n".join(views) + "\n" + sql.strip()


def _mentions(text: str, name: str) -> bool:
    words = "".join(c if c.isalnum() or c == "_" else " " for c in text).split()
    return name in words


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its SQL, or without where SQL cannot say it."""

    def register(function: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = function
        if sql is not None:
            _SQL[name] = _with_views(sql)
        return function

    return register


def _load() -> None:
    from . import composites, ingest, relational, scalars  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
