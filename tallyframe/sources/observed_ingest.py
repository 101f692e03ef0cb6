"""Strict ingest that counts its outcomes while it writes the valid rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .sales_csv import REQUIRED_COLUMNS, ingest_outcome_counts, outcome, parse_lines

# All outcomes a line can have.
OUTCOMES = (
    "header", "rejected:csv", *[f"rejected:{name}" for name in REQUIRED_COLUMNS],
    "rejected:Amount", "not_bought", "missing_key", "accepted",
)
VALID = ("not_bought", "missing_key", "accepted")
COUNTS = "outcome string, rows bigint"


def _counter(name: str) -> Column:
    return F.count_if(F.col("outcome") == name).alias(name)


def write_valid_rows(
    lines: DataFrame, path: str, keys: list[str], line: str = "value"
) -> DataFrame:
    """Write the valid typed rows of ``lines`` to a new folder; return (outcome, rows).

    The counts ride on the write: the lines are read and parsed once. Spark adds the counts of a
    partition up when its task ends well, so a task that fails and runs again counts once. Should
    a part of the write run a second time after it had ended, as when an executor that held it is
    lost, the counts could hold it twice; so the counted valid rows are compared with the rows in
    the written files, which takes the files' footers only, and if they differ the lines are
    counted anew. Outcomes that no line has are left out; ``rows_read`` counts all lines.
    """
    spark = lines.sparkSession
    counted = Observation()
    labelled = parse_lines(lines, line).withColumn("outcome", outcome(keys)).observe(
        counted, F.count(F.lit(1)).alias("rows_read"), *[_counter(name) for name in OUTCOMES]
    )
    valid = labelled.where(F.col("outcome").isin(*VALID)).drop(
        "line", "is_header", "reject_field", "reject_reason", "outcome"
    )
    valid.write.mode("error").parquet(path)
    counts = {name: int(rows or 0) for name, rows in counted.get.items()}
    if not _agree(spark, path, counts):
        return ingest_outcome_counts(parse_lines(lines, line), keys)
    found = [(name, rows) for name, rows in counts.items() if rows or name == "rows_read"]
    return spark.createDataFrame(found, COUNTS)


def _agree(spark: SparkSession, path: str, counts: dict[str, int]) -> bool:
    """Whether the counts add up, and the valid ones to the rows that were written."""
    total = sum(counts[name] for name in OUTCOMES)
    valid = sum(counts[name] for name in VALID)
    return total == counts["rows_read"] and valid == spark.read.parquet(path).count()
