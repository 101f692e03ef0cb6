"""Checks of result frames. A check returns its violations as rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.sinks import column_types

VIOLATIONS = "result string, rule string, row_key string"


@dataclass(frozen=True)
class Contract:
    """What a result frame must fulfil."""

    name: str
    schema: str
    keys: list[str]
    rules: dict[str, Column] = field(default_factory=dict)
    multiplicity: tuple[list[str], int] | None = None


def _row_key(keys: list[str]) -> Column:
    parts = [F.coalesce(F.col(key).cast("string"), F.lit("NULL")) for key in keys]
    return F.concat_ws("|", *parts).alias("row_key")


def schema_violations(frame: DataFrame, contract: Contract) -> DataFrame:
    """One row per column position whose name or type differs from the contract."""
    spark = frame.sparkSession
    expected = column_types(StructType.fromDDL(contract.schema))
    actual = column_types(frame.schema)
    rows = []
    for position in range(max(len(expected), len(actual))):
        if expected[position:position + 1] != actual[position:position + 1]:
            rows.append((contract.name, "schema", f"column {position}"))
    return spark.createDataFrame(rows, VIOLATIONS)


def duplicate_keys(frame: DataFrame, contract: Contract) -> DataFrame:
    counts = frame.groupBy(*contract.keys).count().where(F.col("count") != 1)
    return counts.select(
        F.lit(contract.name).alias("result"), F.lit("unique_key").alias("rule"),
        _row_key(contract.keys),
    )


def broken_rules(frame: DataFrame, contract: Contract) -> DataFrame:
    """One row per (row, broken rule), in one pass; a rule that is null counts as broken."""
    broken = F.array(*[
        F.when(~F.coalesce(holds, F.lit(False)), F.lit(name))
        for name, holds in contract.rules.items()
    ])
    named = frame.select(
        F.lit(contract.name).alias("result"),
        F.explode(F.filter(broken, lambda rule: rule.isNotNull())).alias("rule"),
        _row_key(contract.keys),
    )
    return named


def wrong_multiplicity(frame: DataFrame, contract: Contract) -> DataFrame:
    keys, rows = contract.multiplicity
    counts = frame.groupBy(*keys).count().where(F.col("count") != rows)
    return counts.select(
        F.lit(contract.name).alias("result"), F.lit("multiplicity").alias("rule"), _row_key(keys)
    )


def _keyed(rule: str, keys: list[str]) -> Column:
    parts = F.array(*[F.col(key).cast("string") for key in keys])
    return F.struct(F.lit(rule).alias("rule"), parts.alias("key"))


def violations(frame: DataFrame, contract: Contract) -> DataFrame:
    """All violations of one result, in one scan. With a wrong schema only that is reported.

    Each row stands for its key, for the key of its multiplicity and for each rule it breaks; one
    grouping by (rule, key), merged map-side, then tells duplicate keys, wrong multiplicities and
    broken rules apart by their counts.
    """
    if column_types(StructType.fromDDL(contract.schema)) != column_types(frame.schema):
        return schema_violations(frame, contract)
    entries = [_keyed("unique_key", contract.keys)]
    expected = F.when(F.col("rule") == "unique_key", F.lit(1))
    if contract.multiplicity:
        keys, rows = contract.multiplicity
        entries.append(_keyed("multiplicity", keys))
        expected = expected.when(F.col("rule") == "multiplicity", F.lit(rows))
    for name, holds in contract.rules.items():
        broken = ~F.coalesce(holds, F.lit(False))
        entries.append(F.when(broken, _keyed(name, contract.keys)))
    marked = frame.select(F.explode(F.array(*entries)).alias("entry")).where(F.col("entry").isNotNull())
    counts = marked.groupBy("entry.rule", "entry.key").agg(F.count(F.lit(1)).alias("rows"))
    repeats = F.when(expected.isNull(), F.col("rows")).otherwise(F.lit(1))
    return counts.where(expected.isNull() | (F.col("rows") != expected)).select(
        F.lit(contract.name).alias("result"), "rule",
        F.array_join("key", "|", "NULL").alias("row_key"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), repeats.cast("bigint"))),
    ).drop("col")


def check_all(results: list[tuple[DataFrame, Contract]]) -> DataFrame:
    """All violations of all results; each result is read once."""
    return reduce(DataFrame.unionByName, [violations(f, c) for f, c in results])


def non_negative_finite(column: str) -> Column:
    value = F.col(column)
    return (value >= 0) & (value < F.lit(float("inf")))
