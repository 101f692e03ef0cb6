"""Predicates and ranks over sale rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import OTHER_WHITESPACE, as_column, status_contains, strip

# The status token of a sold row, the pattern of sizes from XXL upwards,
# and the ranks of the sizes below that.
SOLD_TOKEN = "SHIPPED"
AT_LEAST_XXL_PATTERN = "^([2-9]|[1-9][0-9]+)XL$|^X{2,}L$"
SMALL_SIZE_RANKS = {"XS": 1, "S": 2, "M": 3, "L": 4, "XL": 5}


def is_bought(status: Column | str, qty: Column | str) -> Column:
    """Sold row: positive quantity and a status that contains SHIPPED in any case.

    The token has no blanks, so collapsing those in the status could not change the answer.
    A missing quantity or status gives null or false, never true.
    """
    return (as_column(qty) > 0) & status_contains(F.upper(as_column(status)), SOLD_TOKEN)


def size_label(size: Column | str) -> Column:
    """Upper-case size without any blanks, so that `` 3 xl`` is ``3XL``."""
    return F.upper(F.translate(strip(size), " " + OTHER_WHITESPACE, ""))


def is_at_least_xxl(size: Column | str) -> Column:
    """Only a size with an X somewhere is cleaned and matched."""
    matches = F.upper(as_column(size)).contains("X") & size_label(size).rlike(AT_LEAST_XXL_PATTERN)
    return F.coalesce(matches, F.lit(False))


def size_rank(size: Column | str) -> Column:
    """XS=1 … XL=5, XXL=6, 3XL=7 and on; ``XXXL`` ranks as ``3XL``, unknown sizes are null."""
    label = size_label(size)
    numbered = F.regexp_extract(label, "^([1-9][0-9]*)XL$", 1).try_cast("long")
    repeated = F.length(F.regexp_extract(label, "^(X+)L$", 1))
    base = SMALL_SIZE_RANKS["XL"] - 1
    rank = F.when(numbered.isNotNull(), F.try_add(numbered, F.lit(base))).when(repeated > 0, repeated + base)
    for name, value in SMALL_SIZE_RANKS.items():
        rank = rank.when(label == name, F.lit(value))
    return rank.cast("long")


def below_reference_flag(
    count: Column | str, amount: Column | str, reference: Column | str, minimum: int = 3
) -> Column:
    """``count`` reaches ``minimum`` and ``amount`` lies below ``reference``; null-safe."""
    return F.coalesce(
        (as_column(count) >= minimum) & (as_column(amount) < as_column(reference)), F.lit(False)
    )
