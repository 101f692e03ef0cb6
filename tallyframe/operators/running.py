"""Running counts and sums in two levels, for groups too large for one window partition.

Rows are cut into blocks in order of (group, position). Totals per (group, block) are few, so a
window over them gives what lies before each block; a second window runs inside a block. No task
holds more than one block of a group, however large the group is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .keys import join_null_safe
from .moments import MOMENTS, ROWS, merged_moments
from .percentiles import LEVELS, band_statistics, labelled_levels

BLOCK = "_block"


def ordered_blocks(rows: DataFrame, keys: list[str], position: str, label: str) -> DataFrame:
    """Rows staged with the number of their block; blocks follow the order of (keys, position).

    Ranges are cut by a sample of the rows, so a group that holds most of them is spread.
    """
    ranged = rows.repartitionByRange(*keys, position)
    return stage(ranged.withColumn(BLOCK, F.spark_partition_id()), label)


def _levels_of_blocks(blocks: DataFrame, keys: list[str], levels: dict[str, float]) -> DataFrame:
    """Moments per (group, block, level), with the rows before the block and the nearest rank."""
    totals = blocks.groupBy(*keys, BLOCK).agg(*merged_moments())
    group = Window.partitionBy(*keys)
    before = group.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    named = F.array(*[
        F.struct(F.lit(name).alias("percentile_level"), F.lit(p).alias("_p"))
        for name, p in levels.items()
    ])
    return totals.withColumns({
        "_before": F.coalesce(F.sum(ROWS).over(before), F.lit(0)),
        "_group_rows": F.sum(ROWS).over(group),
    }).select("*", F.inline(named)).withColumn(
        "_position", F.ceil(F.col("_group_rows").cast("double") * F.col("_p"))
    )


def _rows_from_threshold(
    blocks: DataFrame, totals: DataFrame, keys: list[str], value: str
) -> DataFrame:
    """Rows at or above each threshold within the block that holds it."""
    held = (F.col("_before") < F.col("_position")) & (
        F.col("_position") <= F.col("_before") + F.col(ROWS)
    )
    chosen = totals.where(held).select(*keys, BLOCK, "percentile_level", "_before", "_position")
    inside = join_null_safe(blocks, chosen, [*keys, BLOCK])
    upwards = Window.partitionBy(*keys, BLOCK, "percentile_level").orderBy(value).rowsBetween(
        Window.unboundedPreceding, 0
    )
    return inside.withColumn("_up_to", F.col("_before") + F.sum(ROWS).over(upwards)).where(
        F.col("_up_to") >= F.col("_position")
    )


def percentiles_by_blocks(
    histogram: DataFrame, keys: list[str], value: str, levels=LEVELS
) -> DataFrame:
    """Same thresholds as ``exact_percentiles`` from the same histogram of (keys, value)."""
    blocks = ordered_blocks(histogram, keys, value, "histogram-blocks")
    totals = _levels_of_blocks(blocks, keys, levels)
    above = _rows_from_threshold(blocks, totals, keys, value)
    thresholds = above.groupBy(*keys, "percentile_level").agg(
        F.min(value).cast("double").alias("threshold")
    )
    return labelled_levels(thresholds, keys, "exact")


def band_stats_by_blocks(
    histogram: DataFrame, keys: list[str], value: str, levels=LEVELS, scale: int = 2
) -> DataFrame:
    """Same rows as ``exact_band_stats``: blocks above a threshold count by their totals."""
    blocks = ordered_blocks(histogram, keys, value, "histogram-blocks")
    totals = stage(_levels_of_blocks(blocks, keys, levels), "block-totals")
    columns = [*keys, "percentile_level", *MOMENTS]
    partly = _rows_from_threshold(blocks, totals, keys, value).select(
        *columns, F.col(value).cast("double").alias("_value")
    )
    wholly = totals.where(F.col("_before") >= F.col("_position")).select(
        *columns, F.lit(None).cast("double").alias("_value")
    )
    merged = partly.unionByName(wholly).groupBy(
        *keys, F.lit("exact").alias("method"), "percentile_level"
    ).agg(F.min("_value").alias("threshold"), *merged_moments())
    return band_statistics(merged, keys, scale)


def running_sums_by_blocks(
    changes: DataFrame, keys: list[str], position: str, names: list[str], block: int,
    following: str = "next_position",
) -> DataFrame:
    """Changes with ``names`` summed up to their position, and the next position of the group.

    ``changes`` holds one row per (keys, position), a whole number; it is read twice, so it should
    be staged. ``block`` is the length of a block in positions.
    """
    placed = changes.withColumn(BLOCK, F.floor(F.col(position) / block))
    order = Window.partitionBy(*keys).orderBy(BLOCK)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    carried = placed.groupBy(*keys, BLOCK).agg(
        F.min(position).alias("_first"), *[F.sum(name).alias(name) for name in names]
    ).select(
        *keys, BLOCK, F.lead("_first").over(order).alias("_next_block"),
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_carried_{name}") for name in names],
    )
    joined = join_null_safe(placed, carried, [*keys, BLOCK])
    inside = Window.partitionBy(*keys, BLOCK).orderBy(position)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    kept = [c for c in changes.columns if c not in names]
    return joined.select(
        *kept, F.coalesce(F.lead(position).over(inside), "_next_block").alias(following),
        *[(F.col(f"_carried_{name}") + F.sum(name).over(so_far)).alias(name) for name in names],
    )

