"""Array-valued expressions: token lists and day ranges."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import STRIPPED_CHARACTERS, as_column, strip


def token_array(raw: Column | str, separator: str = ",") -> Column:
    """Distinct non-blank tokens of a separated list, in first-seen order, case kept.

    The split pattern takes the characters around a separator along, so that no token is
    touched by itself.
    """
    around = f"[\\x{ord(STRIPPED_CHARACTERS[0]):02x}-\\x{ord(STRIPPED_CHARACTERS[-1]):02x}]*"
    parts = F.split(strip(F.coalesce(as_column(raw), F.lit(""))), f"{around}{re.escape(separator)}{around}")
    return F.array_distinct(F.array_remove(parts, ""))


def token_count(raw: Column | str, separator: str = ",") -> Column:
    """Number of distinct tokens; 0 for a null or blank list."""
    return F.size(token_array(raw, separator)).cast("long")


def following_days(date: Column | str, days: Column | int) -> Column:
    """The ``days`` calendar days after ``date``, without ``date`` itself."""
    date = as_column(date)
    last = F.date_add(date, F.lit(days) if isinstance(days, int) else days)
    return F.sequence(F.date_add(date, 1), last)
