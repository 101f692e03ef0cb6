"""Text cleaning and strict parsing, all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters stripped from both ends of a text (U+0000 to U+0020), and
# the whitespace characters besides the blank.
STRIPPED_CHARACTERS = "".join(map(chr, range(0x21)))
OTHER_WHITESPACE = "\t\n\x0b\f\r"

# The date pattern of the sales file and the month key pattern.
SALE_DATE_FORMAT = "MM-dd-yy"
MONTH_FORMAT = "yyyy-MM"


def as_column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def strip(column: Column | str) -> Column:
    """Strip blanks and control characters; ``F.trim`` alone would keep tabs."""
    return F.btrim(as_column(column), F.lit(STRIPPED_CHARACTERS))


def quick_strip(column: Column | str) -> Column:
    """:func:`strip`, which is left to texts that more than blanks surround.

    All stripped characters sort before ``!``. An empty text takes the long way too.
    """
    trimmed = F.trim(as_column(column))
    tight = (trimmed >= F.lit("!")) & (F.substring(trimmed, -1, 1) >= F.lit("!"))
    return F.when(tight, trimmed).otherwise(strip(column))


def blank_to_null(column: Column | str) -> Column:
    return F.nullif(as_column(column), F.lit(""))


def clean_text(column: Column | str) -> Column:
    """Stripped text with its case kept; blank becomes null."""
    return blank_to_null(strip(column))


def _collapsed(text: Column, stripped: Column) -> Column:
    """``stripped`` in upper case with whitespace runs collapsed; blank becomes null.

    The pattern runs only where ``text`` has something to collapse, which is rare; on all others
    it would cost more than everything else here together.
    """
    messy = text.contains("  ")
    for character in OTHER_WHITESPACE:
        messy = messy | text.contains(character)
    collapsed = F.when(messy, F.regexp_replace(stripped, r"\s+", " ")).otherwise(stripped)
    return blank_to_null(F.upper(collapsed))


def normalize_dimension(column: Column | str) -> Column:
    """Stripped upper-case text with whitespace runs collapsed; blank becomes null."""
    return _collapsed(as_column(column), strip(column))


def normalize_stripped(column: Column | str) -> Column:
    """:func:`normalize_dimension` of a text that is stripped already."""
    return _collapsed(as_column(column), as_column(column))


def normalized_equals(column: Column | str, label: str) -> Column:
    """True where the normalized text is exactly ``label``; false for null."""
    return F.coalesce(normalize_dimension(column) == F.lit(label.upper()), F.lit(False))


def status_contains(column: Column | str, token: str) -> Column:
    """True where an already normalized text contains ``token``; null for null.

    On a stored column the test reaches the Parquet scan as a pushed filter.
    """
    return as_column(column).contains(token.upper())


def strict_date(column: Column | str, fmt: str = SALE_DATE_FORMAT) -> Column:
    """Date in ``fmt``; null for an impossible or differently padded date."""
    return date_of_stripped(strip(column), fmt)


def date_of_stripped(column: Column | str, fmt: str = SALE_DATE_FORMAT) -> Column:
    return F.try_to_date(as_column(column), fmt)


def month_key(date: Column | str) -> Column:
    return F.date_format(as_column(date), MONTH_FORMAT)


def to_long(column: Column | str) -> Column:
    """Whole number, or null where the text is not one."""
    return long_of_stripped(strip(column))


def long_of_stripped(column: Column | str) -> Column:
    return as_column(column).try_cast("long")


def to_finite_double(column: Column | str) -> Column:
    """Finite number, or null; NaN and the infinities count as unparsable."""
    return finite_double_of_stripped(strip(column))


def finite_double_of_stripped(column: Column | str) -> Column:
    value = as_column(column).try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)
