"""Report on the lines of a sales file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.profile import field_counters, group_metrics, merged_counters
from ..sources.sales_csv import outcome, parse_lines, typed_ingest
from ..sources.staging import stage

PROFILED_FIELDS = [
    "record_id", "order_id", "order_date", "status", "fulfilment", "service_level", "style",
    "sku", "size", "courier_status", "qty", "amount", "city", "state",
]


def ingest_report(lines: DataFrame, keys: list[str], line: str = "value") -> DataFrame:
    """(section, metric, value) rows: outcomes of all lines, then the quality of valid rows.

    The lines are parsed once; what the report needs of them is staged and read twice, to
    count everything by outcome into a table of a dozen rows, and to count orders and groups.
    """
    labelled = parse_lines(lines, line).withColumn("outcome", outcome(keys))
    parsed = stage(labelled.select("outcome", "month", *PROFILED_FIELDS), "parsed-lines")
    counters = stage(
        field_counters(parsed, PROFILED_FIELDS, "order_date", ["outcome"]), "ingest-counters"
    )
    outcomes = counters.rollup("outcome").agg(F.sum("rows").cast("string").alias("value"))
    outcome_rows = outcomes.select(
        F.lit("outcome").alias("section"),
        F.coalesce("outcome", F.lit("rows_read")).alias("metric"), "value",
    )
    is_valid = (F.col("outcome") != "header") & ~F.col("outcome").startswith("rejected:")
    valid = parsed.where(is_valid)
    quality = merged_counters(counters.where(is_valid), PROFILED_FIELDS).unionByName(
        group_metrics(valid, "order_id", ("sku", "month"))
    )
    return outcome_rows.unionByName(quality.withColumn("section", F.lit("quality")))


def reject_samples(lines: DataFrame, n: int = 10, line: str = "value") -> DataFrame:
    """The first ``n`` rejected lines in order of field, reason and text."""
    rejects = typed_ingest(lines, line, staged=False)[1]
    return rejects.orderBy("reject_field", "reject_reason", "line").limit(n)
