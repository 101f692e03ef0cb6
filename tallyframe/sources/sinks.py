"""Writing results and reading them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .sales_csv import QUOTING


def _mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "error"


def write_csv(
    frame: DataFrame, path: str, overwrite: bool = False, single_file: bool = False
) -> None:
    """CSV with a header; values keep their outer blanks, existing output is refused.

    ``single_file`` is meant for small aggregates: all rows are written by one task, which
    leaves the tasks that make them as they are.
    """
    out = frame.repartition(1) if single_file else frame
    out.write.csv(
        path, mode=_mode(overwrite), header=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **QUOTING,
    )


def column_types(schema: StructType) -> list[tuple[str, str]]:
    """Ordered (name, type) pairs; nullability does not count."""
    return [(field.name, field.dataType.simpleString()) for field in schema.fields]


def write_parquet_checked(frame: DataFrame, path: str, overwrite: bool = False) -> DataFrame:
    """Write, read back, and fail unless names, order and types came through unchanged."""
    frame.write.mode(_mode(overwrite)).parquet(path)
    written = frame.sparkSession.read.parquet(path)
    if column_types(written.schema) != column_types(frame.schema):
        raise ValueError(f"{path} reads back as {written.schema.simpleString()}")
    return written


def read_parquet_result(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv_result(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False
) -> DataFrame:
    """Typed CSV result; a wrong header or a value of another type fails the read.

    Large files are split. ``multi_line=True`` reads cells with line breaks, one task a file.
    """
    return spark.read.csv(
        path, schema=schema, header=True, enforceSchema=False, mode="FAILFAST",
        multiLine=multi_line, **QUOTING,
    )
