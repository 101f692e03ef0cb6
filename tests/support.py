"""Session and comparison helpers for tests and scripts."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyframe-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    database = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        database.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return database


def _sort_key(row: tuple) -> list:
    return [(value is None, str(type(value)), str(value)) for value in row]


def sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    shuffled = [tuple(row[i] for i in order) for row in rows]
    return sorted(shuffled, key=_sort_key)


def _same(left, right) -> bool:
    if isinstance(left, float) and isinstance(right, float):
        return left == right or (math.isnan(left) and math.isnan(right))
    return type(left) is type(right) and left == right


def mismatch(frame: DataFrame, database, sql: str | None) -> str | None:
    """What differs between the frame and the SQL result, or None; values must be equal."""
    rows = [tuple(row) for row in frame.collect()]
    if sql is None:
        return None
    cursor = database.execute(sql)
    columns = [item[0] for item in cursor.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    actual = sorted_rows(frame.columns, rows)
    expected = sorted_rows(columns, cursor.fetchall())
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}; {actual[:3]} / {expected[:3]}"
    unequal = [
        (a, e) for a, e in zip(actual, expected)
        if not all(_same(x, y) for x, y in zip(a, e))
    ]
    if unequal:
        return f"{len(unequal)} of {len(actual)} rows differ: {unequal[:3]}"
    return None
