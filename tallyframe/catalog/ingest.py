"""Reading, ingesting and writing sales files made from the orders table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ingest_report import ingest_report, reject_samples
from ..sources.observed_ingest import write_valid_rows
from ..sources.sales_csv import (
    BYTE_ORDER_MARK,
    SALES_COLUMNS,
    csv_scan,
    header_contract,
    ingest_outcome_counts,
    parse_lines,
    read_sales,
    typed_ingest,
)
from ..sources.sinks import (
    read_csv_result,
    read_parquet_result,
    write_csv,
    write_parquet_checked,
)
from ..sources.staging import new_path
from ..sources.star_schema import order_sales, table
from .registry import query

HEADER = ",".join(SALES_COLUMNS)


def sales_records(spark, sf) -> DataFrame:
    """Every order as a record of the 24 text columns."""
    sales = order_sales(spark, sf)
    money = F.col("amount").cast("decimal(18,2)").cast("string")
    text = {
        "index": F.col("record_id").cast("string"),
        "Order ID": F.concat(F.lit(" "), "order_id"),
        "Date": F.date_format("order_date", "MM-dd-yy"),
        "Status": F.lower("status"),
        "Fulfilment": F.initcap("fulfilment"),
        "Sales Channel ": F.lit("Amazon.in"),
        "ship-service-level": F.col("service_level"),
        "SKU": F.col("sku"),
        "Qty": (F.col("record_id") % 5 - 1).cast("string"),
        "Amount": money,
        "ship-city": F.concat("city", F.lit("  \"x\", y")),
        "ship-state": F.col("state"),
        "promotion-ids": F.col("promotion_ids_raw"),
    }
    return sales.select(
        *[text.get(name, F.lit(None).cast("string")).alias(name) for name in SALES_COLUMNS]
    )


def sales_lines(spark, sf) -> DataFrame:
    """A text file with one CSV line per order, with planted defects, and a header line per
    nation, read back as lines."""
    records = sales_records(spark, sf)
    defect = F.col("index").cast("bigint") % 23
    planted = {
        "index": (2, F.concat(F.lit("x"), "index")), "Order ID": (3, F.lit(" \t")),
        "Date": (4, F.date_format(F.lit("1998-01-01").cast("date"), "'02-30-'yy")),
        "Status": (5, F.lit(None)), "Fulfilment": (6, F.lit("")),
        "ship-service-level": (7, F.lit(" ")), "Qty": (8, F.lit("two")),
        "Amount": (9, F.lit("NaN")), "ship-state": (10, F.lit(None)),
    }
    columns = []
    for name in SALES_COLUMNS:
        value = F.col(name)
        if name in planted:
            number, replacement = planted[name]
            value = F.when(defect == number, replacement).otherwise(value)
        columns.append(value.cast("string").alias(name))
    line = F.to_csv(F.struct(*columns), {
        "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    })
    line = (
        F.when(defect == 1, F.regexp_replace(line, ",[^,]*$", ""))
        .when(defect == 11, F.lit(""))
        .when(defect == 12, F.concat(line, F.lit('"open')))
        .otherwise(line)
    )
    headers = table(spark, sf, "nation").select(F.lit(HEADER).alias("value"))
    path = new_path(spark, "sales-lines")
    records.select(line.alias("value")).unionByName(headers).write.text(path)
    return spark.read.text(path)


def sales_file(spark, sf) -> str:
    path = new_path(spark, "sales-csv")
    write_csv(sales_records(spark, sf), path)
    return path


@query("s1_csv_scan", """
    SELECT CAST(record_id AS VARCHAR) AS index_text, ' ' || order_id AS order_text,
           strftime(order_date, '%m-%d-%y') AS date_text,
           CAST(CAST(amount AS DECIMAL(18, 2)) AS VARCHAR) AS amount_text,
           city || '  "x", y' AS city_text, promotion_ids_raw AS promotions_text
    FROM order_sales""")
def _(spark, sf):
    return csv_scan(spark, sales_file(spark, sf)).select(
        F.col("index").alias("index_text"), F.col("Order ID").alias("order_text"),
        F.col("Date").alias("date_text"), F.col("Amount").alias("amount_text"),
        F.col("ship-city").alias("city_text"), F.col("promotion-ids").alias("promotions_text"),
    )


@query("s1_read_sales", """
    SELECT record_id, order_id,
           make_date(2000 + year(order_date) % 100, month(order_date), day(order_date))
               AS order_date,
           status, fulfilment, service_level, sku, record_id % 5 - 1 AS qty,
           round(amount, 2) AS amount, city || ' "X", Y' AS city, state, promotion_ids_raw,
           record_id % 5 > 1 AND status = 'SHIPPED' AS is_bought
    FROM order_sales""")
def _(spark, sf):
    return read_sales(spark, sales_file(spark, sf)).drop(
        "style", "size", "courier_status", "month"
    )


@query("s2_header_contract", """
    SELECT CASE n_nationkey % 4 WHEN 0 THEN chr(65279) || h WHEN 1 THEN h || 'b'
               WHEN 2 THEN replace(h, 'Order ID,Date,Status', 'Order ID,Date,status') ELSE h END
               AS header_line,
           count(*) AS occurrences, n_nationkey % 4 IN (0, 3) AS matches
    FROM nation, (SELECT '""" + HEADER + """' AS h) GROUP BY ALL""")
def _(spark, sf):
    kind, header = F.col("n_nationkey") % 4, F.lit(HEADER)
    headers = table(spark, sf, "nation").select(
        F.when(kind == 0, F.concat(F.lit(BYTE_ORDER_MARK), header))
        .when(kind == 1, F.concat(header, F.lit("b")))
        .when(kind == 2, F.replace(header, F.lit(",Status"), F.lit(",status")))
        .otherwise(header).alias("value")
    )
    return header_contract(sales_lines(spark, sf).where(F.col("value") != HEADER).union(headers))


@query("s3_typed_ingest_valid", """
    SELECT record_id, order_id, order_date, status, fulfilment, service_level, sku, qty,
           round(amount, 2) AS amount, city || ' "X", Y' AS city, state, promotion_count, month
    FROM valid_lines""")
def _(spark, sf):
    valid, _ = typed_ingest(sales_lines(spark, sf))
    return valid.select(
        "record_id", "order_id", "order_date", "status", "fulfilment", "service_level", "sku",
        "qty", "amount", "city", "state",
        F.size("promotion_ids").cast("bigint").alias("promotion_count"), "month",
    )


@query("s3_typed_ingest_rejects", """
    SELECT reject_field, reject_reason, count(*) AS rows FROM line_outcomes
    WHERE reject_field IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    _, rejects = typed_ingest(sales_lines(spark, sf))
    return rejects.groupBy("reject_field", "reject_reason").agg(F.count(F.lit(1)).alias("rows"))


@query("s4_ingest_outcome_counts", "SELECT * FROM outcome_counts")
def _(spark, sf):
    return ingest_outcome_counts(parse_lines(sales_lines(spark, sf)), ["state"])


@query("s4_observed_outcome_counts", "SELECT * FROM outcome_counts")
def _(spark, sf):
    """The same counts, taken while the valid rows are written."""
    return write_valid_rows(sales_lines(spark, sf), new_path(spark, "valid-rows"), ["state"])


# Part names with everything a CSV cell has to survive.
CELLS_SQL = r"""
    SELECT p_partkey, ' ' || p_name || E', "q"\n' || p_type || ' ' AS cell,
           CASE WHEN p_size % 2 = 0 THEN p_retailprice END AS price
    FROM part"""


def cells(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit(" "), "p_name", F.lit(', "q"\n'), "p_type", F.lit(" ")).alias("cell"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_retailprice")).alias("price"),
    )


@query("s5_write_csv", CELLS_SQL)
def _(spark, sf):
    path = new_path(spark, "cells-csv")
    write_csv(cells(spark, sf), path)
    schema = "p_partkey bigint, cell string, price double"
    return read_csv_result(spark, path, schema, multi_line=True)


@query("s6_write_parquet_checked", CELLS_SQL)
def _(spark, sf):
    return write_parquet_checked(cells(spark, sf), new_path(spark, "cells-parquet"))


@query("s7_read_parquet_result", CELLS_SQL)
def _(spark, sf):
    path = new_path(spark, "cells-parquet")
    write_parquet_checked(cells(spark, sf), path)
    return read_parquet_result(spark, path)


@query("q9_ingest_report", """
    SELECT 'outcome' AS section, outcome AS metric, CAST(rows AS VARCHAR) AS value
    FROM outcome_counts
    UNION ALL SELECT 'quality', metric, CAST(value AS VARCHAR) FROM (
        SELECT unnest(['rows', 'null_record_id', 'null_order_id', 'null_order_date',
                   'null_status', 'null_fulfilment', 'null_service_level', 'null_style',
                   'null_sku', 'null_size', 'null_courier_status', 'null_qty', 'null_amount',
                   'null_city', 'null_state', 'repeated_order_ids', 'largest_order_rows'])
                   AS metric,
               unnest([count(*), 0, 0, 0, 0, 0, 0, count(*), 0, count(*), count(*), 0,
                   count_if(amount IS NULL), 0, count_if(state IS NULL), 0, 1]) AS value
        FROM valid_lines)
    UNION ALL SELECT 'quality', 'first_date', CAST(min(order_date) AS VARCHAR) FROM valid_lines
    UNION ALL SELECT 'quality', 'last_date', CAST(max(order_date) AS VARCHAR) FROM valid_lines
    UNION ALL SELECT 'quality', 'largest_group_rows', CAST(max(n) AS VARCHAR) FROM (
        SELECT count(*) AS n FROM valid_lines GROUP BY sku, month)
    UNION ALL SELECT 'quality', 'large_groups', CAST(count_if(n > 1000) AS VARCHAR) FROM (
        SELECT count(*) AS n FROM valid_lines GROUP BY sku, month)""")
def _(spark, sf):
    return ingest_report(sales_lines(spark, sf), ["state"])


@query("q9_reject_samples", """
    SELECT CAST(record_id AS VARCHAR) AS record, 'Amount' AS reject_field,
           'invalid' AS reject_reason
    FROM line_outcomes WHERE reject_field = 'Amount'
    ORDER BY CAST(record_id AS VARCHAR) || ',' LIMIT 10""")
def _(spark, sf):
    return reject_samples(sales_lines(spark, sf)).select(
        F.split("line", ",")[0].alias("record"), "reject_field", "reject_reason"
    )
