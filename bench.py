"""Time the headline queries on one table folder; prints one JSON line.

First the two sale tables are joined together and written once, as ``prepare_sec``; like the
sales file they stand for, they are flat. ``SKUS`` of them give about as many (sku, month) groups
as the published runs had. The percentile queries then run on a cached base, once to warm up
and five times, and report the mean. All others read the sale tables and build their plan
anew each time, once to warm up and three times; so does the strict ingest of a sales file.
Record ids are unique here, which is promised to the queries. All other settings are
Spark's defaults, but for one shuffle partition a core.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.catalog.ingest import sales_lines
from tallyframe.plans.cancelled_rate import conditional_rate_by_city
from tallyframe.plans.percentile_bands import compare_methods, percentile_band_stats, sku_month_base
from tallyframe.plans.variety_median import variety_median
from tallyframe.plans.window_winner import dynamic_window_winner
from tallyframe.sources.sales_csv import typed_ingest
from tallyframe.sources.staging import drop_staged, stage
from tallyframe.sources.star_schema import line_sales, order_sales

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SKUS = 206


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tallyframe-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(build, runs: int) -> float:
    samples = []
    for attempt in range(runs + 1):
        started = time.perf_counter()
        run(build())
        if attempt:
            samples.append(time.perf_counter() - started)
    return round(statistics.mean(samples), 4)


def main() -> None:
    spark = session()
    started = time.perf_counter()
    lines = stage(line_sales(spark, FOLDER).repartition(int(CPUS)), "line-sales")
    sku = F.concat(F.lit("S"), (F.col("record_id") % SKUS).cast("string"))
    orders = order_sales(spark, FOLDER).withColumn("sku", sku).repartition(int(CPUS))
    orders = stage(orders, "order-sales")
    sales_file = sales_lines(spark, FOLDER)
    prepared = round(time.perf_counter() - started, 4)
    base = sku_month_base(orders, unique_records=True).cache()
    base.count()
    groups = base.select("sku", "month").distinct().count()
    exact, approx = (percentile_band_stats(base, method) for method in ("exact", "approx"))
    cached = {
        "q4_exact": lambda: exact,
        "q4_approx": lambda: approx,
        "q4_both": lambda: percentile_band_stats(base, "both"),
        "q6_set_difference_summary": lambda: compare_methods(base)[1],
    }
    scanned = {
        "q1_window_winner": lambda: dynamic_window_winner(lines),
        "q2_variety_median": lambda: variety_median(lines),
        "q3_cancelled_rate": lambda: conditional_rate_by_city(orders, 2350, unique_records=True),
        "q4_exact_uncached": lambda: percentile_band_stats(
            sku_month_base(orders, unique_records=True), "exact"
        ),
        "s3_typed_ingest": lambda: typed_ingest(sales_file)[0],
    }
    times = {name: timed(build, 5) for name, build in cached.items()}
    base.unpersist()
    times |= {name: timed(build, 3) for name, build in scanned.items()}
    print(json.dumps({
        "metric": "total mean seconds of the headline queries",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "prepare_sec": prepared,
        "sku_month_groups": groups,
        "cpus": int(CPUS),
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))
    drop_staged(spark)
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
