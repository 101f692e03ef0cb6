"""Words of texts as array columns, by DataFrame functions only."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: after A-Z are lower-cased, everything in these ranges separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Characters beyond ASCII that lower() would change.
_OTHER_CAPITALS = r"[\x{80}-\x{10FFFF}&&[\p{IsUppercase}\p{IsTitlecase}]]"


def lower_ascii(text: Column) -> Column:
    """Text with A-Z, and nothing else, in lower case."""
    exact = F.translate(text, ascii_uppercase, ascii_lowercase)
    return F.when(text.rlike(_OTHER_CAPITALS), exact).otherwise(F.lower(text))


def words(text: Column) -> Column:
    """Lower-cased words of a text; null has none."""
    lowered = lower_ascii(F.coalesce(text.cast("string"), F.lit("")))
    return F.array_remove(F.split(lowered, SEPARATORS), "")
