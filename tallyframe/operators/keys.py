"""Key handling and joins shared by the other operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The join strategies that can be asked for, as Spark names them.
JOIN_STRATEGIES = ("broadcast", "merge", "shuffle_hash")


def require_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with all keys present, as tests that reach the scan as pushed filters."""
    return frame.where(reduce(Column.__and__, [F.col(key).isNotNull() for key in keys]))


def any_missing(keys: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(key).isNull() for key in keys])


def missing_key_counts(frame: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many rows have all keys, and how many lack at least one."""
    missing = any_missing(keys)
    return frame.agg(
        F.count_if(~missing).alias("kept_rows"), F.count_if(missing).alias("dropped_rows")
    )


def zero_fill(frame: DataFrame, columns: list[str]) -> DataFrame:
    return frame.fillna(0, subset=columns)


def label_columns(frame: DataFrame, **labels: str | Column) -> DataFrame:
    """Add constant or computed label columns."""
    return frame.withColumns(
        {name: F.lit(v) if isinstance(v, str) else v for name, v in labels.items()}
    )


def dedup(frame: DataFrame, keys: list[str]) -> DataFrame:
    return frame.dropDuplicates(keys)


def exists(frame: DataFrame) -> bool:
    """True if the frame has a row; stops at the first one found."""
    return not frame.isEmpty()


def existing_values(frame: DataFrame, column: str, values: list) -> DataFrame:
    """(column, found): for each of a few values, does a row hold it? One pass, as a plan."""
    asked = F.array(*[F.lit(value) for value in values])
    held = frame.agg(*[
        F.max(F.coalesce(F.col(column) == value, F.lit(False))).alias(f"_{place}")
        for place, value in enumerate(values)
    ])
    flags = F.array(*[F.coalesce(f"_{place}", F.lit(False)) for place in range(len(values))])
    return held.select(F.inline(F.arrays_zip(asked.alias(column), flags.alias("found"))))


def lookup_join(
    frame: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "inner",
    strategy: str | None = None,
) -> DataFrame:
    """Join a fact frame with a lookup frame; the strategy never changes the rows.

    By default Catalyst broadcasts the lookup when its known or measured size in bytes is below
    the session's threshold. A strategy that is asked for is the one that runs: ask for a
    broadcast only where the size of the lookup is known.
    """
    if strategy is None:
        return frame.join(lookup, keys, how)
    if strategy not in JOIN_STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}, expected one of {JOIN_STRATEGIES}")
    return frame.join(lookup.hint(strategy), keys, how)


def left_counts(frame: DataFrame, counts: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Left join of counts per key, zero where there is no count."""
    return zero_fill(frame.join(counts, keys, "left"), names)


def join_null_safe(frame: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which null keys match each other; the keys come out once."""
    renamed = other.withColumnsRenamed({key: f"_other_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_other_{key}")) for key in keys]
    return frame.join(renamed, reduce(Column.__and__, same)).drop(*[f"_other_{key}" for key in keys])
