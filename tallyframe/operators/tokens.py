"""Promotion tokens: exploding, lifespans, and counts per record."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import token_array, token_count
from ..functions.text import strip
from ..sources.staging import stage
from .keys import left_counts, require_keys

# Fixed value: a token counts as long-lived from this span in days.
MIN_SPAN_DAYS = 2


def tokens(
    base: DataFrame,
    record: str = "record_id",
    date: str = "order_date",
    raw: str = "promotion_ids_raw",
    unique_records: bool = False,
) -> DataFrame:
    """One row per distinct (record, token).

    A record id may stand in several rows, and duplicates are removed across them. The array
    of a row is free of duplicates, so ``unique_records=True``, the promise that no id is
    repeated, saves the shuffle.
    """
    exploded = require_keys(base, [raw]).select(
        record, date, F.explode(token_array(raw)).alias("promotion_id")
    )
    return exploded if unique_records else exploded.dropDuplicates([record, "promotion_id"])


def distinct_tokens(
    base: DataFrame, record: str = "record_id", raw: str = "promotion_ids_raw"
) -> DataFrame:
    """(record, token), each once, over all rows of a record; rows without either are left out.

    A task sorts its tokens, which spills, and keeps the first of equal neighbours. Two hash tables
    of all tokens, as ``distinct`` makes them, take a multiple of that memory.
    """
    rows = require_keys(base, [record, raw]).select(
        record, F.explode(token_array(raw)).alias("promotion_id")
    )
    same = Window.partitionBy(record, "promotion_id").orderBy(record)
    first = rows.withColumn("_place", F.row_number().over(same)).where(F.col("_place") == 1)
    return first.select(record, "promotion_id")


def token_occurrences(
    base: DataFrame, date: str = "order_date", raw: str = "promotion_ids_raw"
) -> DataFrame:
    """(date, token) for every token as written, repeats included.

    Enough wherever repeats change nothing, as for the span of a token, and cheaper: all of
    it is compiled, while the array functions behind :func:`tokens` are interpreted.
    """
    parts = require_keys(base, [raw, date]).select(
        date, F.explode(F.split(raw, ",")).alias("promotion_id")
    )
    stripped = parts.select(date, strip("promotion_id").alias("promotion_id"))
    return stripped.where(F.length("promotion_id") > 0)


def lifespans(
    token_rows: DataFrame, record: str = "record_id", date: str = "order_date"
) -> DataFrame:
    """First day, last day, number of records and span in days of every token.

    ``token_rows`` hold each (record, token) once, as :func:`tokens` yields them, so counting
    rows counts distinct records and everything is merged map-side.
    """
    return require_keys(token_rows, [date]).groupBy("promotion_id").agg(
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.count(record).alias("promoted_record_count"),
    ).withColumn("span_days", F.datediff("last_date", "first_date"))


def long_lived(
    token_rows: DataFrame, min_span_days: int = MIN_SPAN_DAYS, date: str = "order_date"
) -> DataFrame:
    """Ids of the tokens whose first and last day lie at least ``min_span_days`` apart.

    ``token_rows`` may repeat a token: first and last day are the same.
    """
    spans = token_rows.groupBy("promotion_id").agg(
        F.datediff(F.max(date), F.min(date)).alias("span_days")
    )
    return spans.where(F.col("span_days") >= min_span_days).select("promotion_id")


def temporally_valid_tokens(
    base: DataFrame,
    min_span_days: int = MIN_SPAN_DAYS,
    staged: bool = True,
    **columns,
) -> DataFrame:
    """Token rows whose token is long-lived.

    With ``staged`` the set of long-lived ids is written first. Its file size then decides
    whether the token rows stay where they are (broadcast) or are shuffled by token, where
    adaptive execution splits a token that dominates.
    """
    named = {k: v for k, v in columns.items() if k in ("date", "raw")}
    date = columns.get("date", "order_date")
    valid = long_lived(token_occurrences(base, **named), min_span_days, date)
    if staged:
        valid = stage(valid, "long-lived-tokens")
    return tokens(base, **columns).join(valid, "promotion_id", "left_semi")


def valid_token_count(valid_tokens: DataFrame, record: str = "record_id") -> DataFrame:
    """Valid tokens per record that has any; each (record, token) occurs once."""
    return valid_tokens.groupBy(record).agg(
        F.count("promotion_id").alias("valid_promotion_count")
    )


def with_token_count(
    base: DataFrame,
    record: str = "record_id",
    raw: str = "promotion_ids_raw",
    unique_records: bool = False,
    name: str = "promotion_count",
    staged: bool = True,
) -> DataFrame:
    """Add the number of distinct tokens of each record, 0 for none.

    The tokens of all rows of a record are counted together and joined back; with ``staged`` the
    counts are written first, so that no task holds the rows for both steps. With the promise
    ``unique_records=True`` it is one expression of the row.
    """
    if unique_records:
        return base.withColumn(name, token_count(raw))
    counts = distinct_tokens(base, record, raw).groupBy(record).agg(
        F.count("promotion_id").alias(name)
    )
    if staged:
        counts = stage(counts, "token-counts")
    return left_counts(base, counts, [record], [name])


def per_record_counts(
    base: DataFrame, record: str = "record_id", raw: str = "promotion_ids_raw"
) -> DataFrame:
    """One row per record id with its number of distinct tokens."""
    rows = base.select(record, F.explode_outer(token_array(raw)).alias("promotion_id"))
    return rows.groupBy(record).agg(F.count_distinct("promotion_id").alias("promotion_count"))
