"""Exact moments of a money column.

Amounts enter as whole minor units (cents at ``scale=2``), so their sums are integers:
the result depends neither on the row order nor on how partial aggregates are merged,
and two groups with equal variance compare as equal. An amount that is no whole number of
units, not finite, or beyond 2^53 units fails the query, in ANSI mode or not; amounts with
more decimals need a larger ``scale``.

A square of minor units outgrows 64 bits long before its sum does, and decimal sums cost
about ten times as much as long ones. So a value is cut into ``high * 2^31 + low``, and the
sum of squares is kept as four long sums that are put together once per group:

    value² = high² * 2^62 + high * low * 2^32 + low²,   low² = blocks * 2^24 + units

All sums are long sums, merged map-side. A sum that leaves 64 bits fails instead of wrapping,
whatever the ANSI setting; for values up to 10^7 units that takes more than 9 * 10^11 rows
in one group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_column

ROWS = "row_count"
VALUES = "value_count"
TOTAL = "value_sum"
UNITS = "square_units"
BLOCKS = "square_blocks"
CROSS = "square_cross"
HIGH = "square_high"
MOMENTS = (ROWS, VALUES, TOTAL, UNITS, BLOCKS, CROSS, HIGH)

_LOW_BITS = 31
_UNIT_BITS = 24
_WIDE = "decimal(38,0)"


_EXACT_UNITS = float(1 << 53)


def minor_units(value: Column | str, scale: int = 2) -> Column:
    """Whole minor units; null for null, an error for an amount that they can't hold exactly."""
    amount = as_column(value).cast("double")
    units = F.rint(amount * F.lit(10.0**scale))
    exact = (F.abs(units) <= _EXACT_UNITS) & (units / F.lit(10.0**scale) == amount)
    message = F.concat(
        F.lit("amount "), amount.cast("string"), F.lit(f" is no whole number of 10^-{scale}")
    )
    return F.when(exact, units.cast("bigint")).when(
        amount.isNotNull(), F.raise_error(message).cast("bigint")
    )


def _checked_sum(part: Column | str, count: Column, name: str) -> Column:
    """Sum of longs, 0 if there is none, an error if it leaves 64 bits."""
    overflow = F.raise_error(F.lit(f"{name} leaves 64 bits")).cast("bigint")
    return F.when(count > 0, F.coalesce(F.try_sum(part), overflow)).otherwise(F.lit(0))


def moments(value: Column | str, scale: int = 2) -> list[Column]:
    """Aggregates of raw rows."""
    units = minor_units(value, scale)
    high = F.shiftright(units, _LOW_BITS)
    low = units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    square = low * low
    sums = {
        TOTAL: units,
        UNITS: square.bitwiseAND(F.lit((1 << _UNIT_BITS) - 1)),
        BLOCKS: F.shiftright(square, _UNIT_BITS),
        CROSS: high * low,
        HIGH: high * high,
    }
    return [
        F.count(F.lit(1)).alias(ROWS),
        F.count(as_column(value)).alias(VALUES),
        *[
            _checked_sum(part, F.count(as_column(value)), name).alias(name)
            for name, part in sums.items()
        ],
    ]


def merged_moments() -> list[Column]:
    """Aggregates that merge moment rows of a finer grain."""
    return [
        F.when(F.count(name) > 0, _checked_sum(name, F.count(name), name)).alias(name)
        for name in MOMENTS
    ]


def signed_sum(name: str, sign: Column) -> Column:
    """Sum of a moment with signs; an error if it leaves 64 bits."""
    return _checked_sum(F.col(name) * sign, F.count(name), name)


def group_moments(
    frame: DataFrame, keys: list[str], value: Column | str, scale: int = 2
) -> DataFrame:
    """One row of moments per group; partial sums are merged before the shuffle."""
    return frame.groupBy(*keys).agg(*moments(value, scale))


def square_sum() -> Column:
    """Sum of the squared minor units as an exact integer."""
    parts = {UNITS: 0, BLOCKS: _UNIT_BITS, CROSS: _LOW_BITS + 1, HIGH: 2 * _LOW_BITS}
    terms = [
        F.try_multiply(F.col(name).cast("decimal(20,0)"), F.expr(f"{1 << bits}BD")).cast(_WIDE)
        for name, bits in parts.items()
    ]
    return reduce(lambda one, two: F.try_add(one, two).cast(_WIDE), terms)


def finished_moments(frame: DataFrame) -> DataFrame:
    """Moment rows with the sum of squares as one column in place of its parts."""
    return frame.withColumn("value_square_sum", square_sum()).drop(UNITS, BLOCKS, CROSS, HIGH)


def mean_value(scale: int = 2) -> Column:
    """Mean of the non-null values; null if there is none."""
    return F.expr(f"cast({TOTAL} as double) / nullif({VALUES}, 0) / {10.0**scale}D")


def population_variance(scale: int = 2) -> Column:
    """Population variance of the non-null values; null if there is none.

    With ``m`` the whole part of the mean, the squares around it are
    ``centred = squares - 2 m total + count m²``, and ``count centred - (total - count m)²`` is
    an exact integer that is never negative, the same for equal variances. One form serves all
    sizes; a group so large that it leaves 38 digits fails.
    """
    wide = "decimal(20,0)"
    count, total = F.col(VALUES).cast(wide), F.col(TOTAL).cast(wide)
    middle = F.expr(f"cast({TOTAL} div nullif({VALUES}, 0) as {wide})")
    two = F.lit(2).cast(wide)
    centred = F.try_add(
        F.try_subtract(square_sum(), F.try_multiply(two, F.try_multiply(middle, total).cast(_WIDE))),
        F.try_multiply(count, F.try_multiply(middle, middle).cast(_WIDE)),
    )
    rest = F.try_subtract(total, F.try_multiply(count, middle))
    spread = F.try_subtract(
        F.try_multiply(count, centred.cast(_WIDE)), F.try_multiply(rest.cast(wide), rest.cast(wide))
    )
    error = F.raise_error(F.lit("the variance of a group leaves 38 digits")).cast("double")
    divisor = F.col(VALUES).cast("double")
    variance = F.coalesce(spread.cast("double"), error) / divisor / divisor
    return F.when(F.col(VALUES) > 0, variance / F.lit(10.0 ** (2 * scale)))


def population_stddev(scale: int = 2) -> Column:
    return F.sqrt(population_variance(scale))
