"""Stored quantile sketches that merge without rereading rows.

A sketch row summarises the values of one group and time slice in a few kilobytes at most. Slices
merge to longer ones by their sketches alone, so a table of daily sketches answers for months
while the rows stay untouched. Up to about ``k`` values a sketch is exact; beyond that the rank of
an answer is off by a share of the rows that falls with ``k``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_column
from .keys import require_keys
from .percentiles import LEVELS, labelled_levels, percentile_rows

SKETCH = "sketch"
SIZE = 200
#: Fixed value: rank error of a sketch of 200, as a share of the rows, held in 99 of 100 cases.
RANK_ERROR = 0.0133


def sketch(value: Column | str, k: int = SIZE) -> Column:
    """Sketch of the non-null whole numbers of a group."""
    return F.call_function("kll_sketch_agg_bigint", as_column(value).cast("bigint"), F.lit(k))


def sketch_table(frame: DataFrame, keys: list[str], value: str, k: int = SIZE) -> DataFrame:
    """(keys, sketch_rows, sketch), merged map-side; rows without value are left out."""
    rows = require_keys(frame, [value])
    return rows.groupBy(*keys).agg(
        F.count(value).alias("sketch_rows"), sketch(value, k).alias(SKETCH)
    )


def merged_sketches(sketches: DataFrame, keys: list[str | Column]) -> DataFrame:
    """Sketch rows of a coarser grain; ``keys`` may be expressions over the finer keys."""
    return sketches.groupBy(*keys).agg(
        F.sum("sketch_rows").alias("sketch_rows"),
        F.call_function("kll_merge_agg_bigint", F.col(SKETCH)).alias(SKETCH),
    )


def sketch_percentiles(sketches: DataFrame, keys: list[str], levels=LEVELS) -> DataFrame:
    """Thresholds of each sketch row: the value at about ``ceil(p * N)``, without interpolation."""
    ranks = F.array(*[F.lit(float(p)) for p in levels.values()])
    values = F.call_function("kll_sketch_get_quantile_bigint", F.col(SKETCH), ranks)
    arrays = sketches.select(*keys, values.alias("thresholds"))
    return labelled_levels(percentile_rows(arrays, keys, "thresholds", levels), keys, "sketch")


def rank_errors(
    frame: DataFrame, thresholds: DataFrame, keys: list[str], value: str, levels=LEVELS
) -> DataFrame:
    """How far each threshold's rank is from its level, as a share of the group's rows.

    One scan: the rows below and up to each threshold are counted. The error is 0 where the level
    lies between the two shares.
    """
    wide = thresholds.groupBy(*keys).pivot("percentile_level", list(levels)).agg(F.first("threshold"))
    rows = require_keys(frame, [value]).join(wide, keys)
    counts = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("group_rows"),
        *[F.count_if(F.col(value) < F.col(name)).alias(f"_below_{name}") for name in levels],
        *[F.count_if(F.col(value) <= F.col(name)).alias(f"_up_to_{name}") for name in levels],
    )
    named = F.array(*[
        F.struct(
            F.lit(name).alias("percentile_level"), F.lit(p).alias("_p"),
            F.col(f"_below_{name}").alias("_below"), F.col(f"_up_to_{name}").alias("_up_to"),
        )
        for name, p in levels.items()
    ])
    total = F.col("group_rows")
    error = F.greatest(
        F.lit(0.0), F.col("_below") / total - F.col("_p"), F.col("_p") - F.col("_up_to") / total
    )
    return counts.select(*keys, "group_rows", F.inline(named)).select(
        *keys, "percentile_level", "group_rows", error.alias("rank_error")
    )
