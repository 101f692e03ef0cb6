"""Sale rows derived from the TPC-H-style star schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _order_states(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the nation and the segment of their customer."""
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return table(spark, folder, "orders").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )


def _part_size() -> Column:
    size = F.col("p_size")
    return (
        F.when(size == 50, "3XL").when(size == 49, "xxl")
        .when(size % 4 == 0, "S").when(size % 4 == 1, "M").when(size % 4 == 2, "L")
        .otherwise("XL")
    )


def line_sales(spark: SparkSession, folder: str) -> DataFrame:
    """One sale row per order line."""
    lines = table(spark, folder, "lineitem").join(
        _order_states(spark, folder), F.col("l_orderkey") == F.col("o_orderkey")
    ).join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    flag = F.col("l_returnflag")
    return lines.select(
        F.col("n_name").alias("state"),
        F.to_date("l_shipdate").alias("order_date"),
        F.when(flag == "N", "Cancelled").when(flag == "R", " Shipped -  Returned to Seller")
        .otherwise("shipped").alias("status"),
        (F.col("l_quantity").cast("bigint") - 2).alias("qty"),
        F.when(F.col("l_discount") != 0, F.col("l_extendedprice")).alias("amount"),
        F.concat_ws("-", "p_brand", "p_type").alias("style"),
        F.col("l_partkey").cast("string").alias("sku"),
        _part_size().alias("size"),
    )


def order_promotions(spark: SparkSession, folder: str) -> DataFrame:
    """Raw promotion list per order, with a repeated and a blank token.

    The set of tokens is merged map-side and cannot outgrow the 500 promotion ids, so a
    single huge order stays small.
    """
    token = F.concat(F.lit("PROMO-"), (F.col("l_partkey") % 500).cast("string"))
    tokens = table(spark, folder, "lineitem").where(F.col("l_discount") > 0.03).groupBy(
        F.col("l_orderkey").alias("record_id")
    ).agg(F.sort_array(F.collect_set(token)).alias("tokens"))
    return tokens.select(
        "record_id",
        F.concat_ws(", ", "tokens", F.lit(" "), F.element_at("tokens", 1)).alias(
            "promotion_ids_raw"
        ),
    )


def order_sales(spark: SparkSession, folder: str) -> DataFrame:
    """One sale row per order, with the promotions of its lines."""
    orders = _order_states(spark, folder)
    shipped = F.col("o_orderstatus") == "F"
    priority = F.col("o_orderpriority")
    sales = orders.select(
        F.col("o_orderkey").alias("record_id"),
        F.concat(F.lit("O-"), F.col("o_orderkey").cast("string")).alias("order_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.when(F.col("o_orderstatus") == "P", "CANCELLED").when(shipped, "SHIPPED")
        .otherwise("PENDING").alias("status"),
        F.when(priority.isin("4-NOT SPECIFIED", "5-LOW"), "STANDARD").otherwise("EXPEDITED")
        .alias("service_level"),
        F.when(F.col("c_custkey") % 2 == 0, "MERCHANT").otherwise("AMAZON").alias("fulfilment"),
        F.when(shipped, "SHIPPED").otherwise("UNSHIPPED").alias("courier_status"),
        F.col("n_name").alias("state"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_mktsegment").alias("sku"),
        F.when(F.col("o_orderkey") % 17 != 0, F.col("o_totalprice")).alias("amount"),
    ).withColumn("month", F.date_format("order_date", "yyyy-MM"))
    return sales.join(order_promotions(spark, folder), "record_id", "left")
