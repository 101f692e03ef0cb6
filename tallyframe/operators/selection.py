"""Values at given ranks of large groups, by radix refinement.

A sort, or an aggregate that keeps every distinct value, gathers a group in one task. Here a group
is counted by the high bits of its values; the bucket that holds the rank is picked, and only the
values inside it are counted by their next bits. Each round divides the range by up to ``BUCKETS``,
so 64 bits take at most six rounds and values in a narrow range take one. A round counts map-side,
and what meets in one place is one row per bucket. Groups with very many distinct values are dealt
to several tasks by a salt of the value, so no task reads more than its share of one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .keys import require_keys
from .moments import ROWS, minor_units

Rank = Callable[[Column], Column]

BUCKETS = 4096
#: A group gets one salt more for each so many distinct values.
SALT_VALUES = 100_000
_SHIFTS = (0, 12, 24, 36, 48, 60)


def nearest_rank(p: float) -> Rank:
    """Position ``ceil(p * N)`` of N values."""
    return lambda rows: F.ceil(rows.cast("double") * F.lit(p)).cast("bigint")


def _same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join in which null keys match each other; the keys come out once."""
    renamed = right.withColumnsRenamed({key: f"_other_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_other_{key}")) for key in keys]
    joined = left.join(renamed, reduce(Column.__and__, same), how)
    return joined.drop(*[f"_other_{key}" for key in keys])


def _shift(low: Column, high: Column) -> Column:
    """The fewest low bits to leave out so that the range has at most BUCKETS buckets.

    Halves are subtracted, as the difference of two longs may leave 64 bits.
    """
    chosen = F.lit(_SHIFTS[-1])
    for shift in reversed(_SHIFTS[:-1]):
        spread = F.shiftright(high, max(shift, 1)) - F.shiftright(low, max(shift, 1))
        room = BUCKETS // 2 if shift == 0 else BUCKETS
        chosen = F.when(spread < room, F.lit(shift)).otherwise(chosen)
    return chosen


def _refined(counts: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The open ranks of ``state``, each in the bucket of its range that holds it."""
    spread = state.where(F.col("_low") < F.col("_high")).withColumn(
        "_bits", _shift(F.col("_low"), F.col("_high"))
    ).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    inside = _same_keys(counts, spread, [*keys, "_salt"], "inner").where(
        F.col("_value").between(F.col("_low"), F.col("_high"))
    )
    ranks = [*keys, "_name", "_rank", "_salts"]
    buckets = inside.groupBy(
        *ranks, F.call_function("shiftright", F.col("_value"), F.col("_bits")).alias("_bucket")
    ).agg(
        F.sum(ROWS).alias("_rows"), F.min("_value").alias("_low"), F.max("_value").alias("_high")
    )
    upwards = Window.partitionBy(*keys, "_name").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, 0
    )
    counted = buckets.withColumn("_up_to", F.sum("_rows").over(upwards))
    below = F.col("_up_to") - F.col("_rows")
    return counted.where((below < F.col("_rank")) & (F.col("_up_to") >= F.col("_rank"))).select(
        *keys, "_name", (F.col("_rank") - below).alias("_rank"), "_salts", "_low", "_high"
    )


def values_at_ranks(
    frame: DataFrame, keys: list[str], value: str, ranks: dict[str, Rank], scale: int = 0,
    salt_values: int = SALT_VALUES,
) -> DataFrame:
    """(keys, rank_name, value, group_rows): the values at ranks of each group, nulls left out.

    ``ranks`` gives, by name, a position from 1 to the number of rows of a group. Values are whole
    numbers, or with ``scale`` amounts with that many decimals, which come back as double. A null
    key is a group of its own.
    """
    units = minor_units(value, scale) if scale else F.col(value).cast("bigint")
    rows = require_keys(frame, [value]).select(*keys, units.alias("_value"))
    counts = stage(rows.groupBy(*keys, "_value").agg(F.count(F.lit(1)).alias(ROWS)), "value-counts")
    sizes = counts.groupBy(*keys).agg(
        F.sum(ROWS).alias("_group_rows"), F.min("_value").alias("_low"),
        F.max("_value").alias("_high"),
        (F.lit(1) + F.floor(F.count(F.lit(1)) / salt_values)).cast("int").alias("_salts"),
    )
    sizes = stage(sizes, "group-sizes")
    salted = _same_keys(
        counts, sizes.where(F.col("_salts") > 1).select(*keys, "_salts"), keys, "left"
    ).withColumn(
        "_salt", F.pmod(F.xxhash64("_value"), F.coalesce("_salts", F.lit(1))).cast("int")
    ).drop("_salts")
    named = F.array(*[
        F.struct(F.lit(name).alias("_name"), rank(F.col("_group_rows")).alias("_rank"))
        for name, rank in ranks.items()
    ])
    state = stage(
        sizes.select("*", F.inline(named)).select(*keys, "_name", "_rank", "_salts", "_low", "_high"),
        "ranks",
    )
    while not state.where(F.col("_low") < F.col("_high")).isEmpty():
        found = state.where(F.col("_low") == F.col("_high"))
        state = stage(found.unionByName(_refined(salted, state, keys)), "ranks")
    result = F.col("_low") / F.lit(10.0**scale) if scale else F.col("_low")
    return _same_keys(state, sizes.select(*keys, "_group_rows"), keys, "inner").select(
        *keys, F.col("_name").alias("rank_name"), result.alias(value),
        F.col("_group_rows").alias("group_rows"),
    )


def median_by_selection(
    frame: DataFrame, keys: list[str], value: str, median: str = "median", size: str = "group_size",
    scale: int = 0, salt_values: int = SALT_VALUES,
) -> DataFrame:
    """Same result as ``exact_median``, without a group's distinct values meeting in one task."""
    middles = {
        "low": lambda rows: F.floor((rows + 1) / 2).cast("bigint"),
        "high": lambda rows: F.floor(rows / 2).cast("bigint") + 1,
    }
    found = values_at_ranks(frame, keys, value, middles, scale, salt_values)
    def middle(name):
        return F.max(F.when(F.col("rank_name") == name, F.col(value).cast("double")))

    return found.groupBy(*keys).agg(
        (middle("low") * 0.5 + middle("high") * 0.5).alias(median), F.max("group_rows").alias(size)
    )


def percentiles_by_selection(
    frame: DataFrame, keys: list[str], value: str, levels: dict[str, float], scale: int = 0,
    salt_values: int = SALT_VALUES,
) -> DataFrame:
    """(keys, percentile_level, threshold): nearest ranks, by radix refinement."""
    ranks = {name: nearest_rank(p) for name, p in levels.items()}
    found = values_at_ranks(frame, keys, value, ranks, scale, salt_values)
    return found.select(
        *keys, F.col("rank_name").alias("percentile_level"),
        F.col(value).cast("double").alias("threshold"),
    )
