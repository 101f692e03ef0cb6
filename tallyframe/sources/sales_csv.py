"""The 24-column sales CSV: lenient scan, strict typed ingest, and outcome counts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.arrays import token_array
from ..functions.sales import is_bought
from ..functions.text import (
    as_column,
    blank_to_null,
    date_of_stripped,
    finite_double_of_stripped,
    long_of_stripped,
    month_key,
    normalize_stripped,
    strip,
)
from .staging import stage

# The columns of the sales file in file order, and how its header line starts.
SALES_COLUMNS = (
    "index",
    "Order ID",
    "Date",
    "Status",
    "Fulfilment",
    "Sales Channel ",
    "ship-service-level",
    "Style",
    "SKU",
    "Category",
    "Size",
    "ASIN",
    "Courier Status",
    "Qty",
    "currency",
    "Amount",
    "ship-city",
    "ship-state",
    "ship-postal-code",
    "ship-country",
    "promotion-ids",
    "B2B",
    "fulfilled-by",
    "Unnamed: 22",
)
HEADER_START = "index,Order ID,Date,"

# The columns no record may leave blank, in the order they are checked.
REQUIRED_COLUMNS = (
    "index", "Order ID", "Date", "Status", "Fulfilment", "ship-service-level", "Qty",
)

# The columns that are stripped once and used from there, and of these the ones
# that are normalized or parsed, with the typed column each of them becomes.
STRIPPED_COLUMNS = (
    "index", "Order ID", "Date", "Status", "Fulfilment", "ship-service-level", "Style", "SKU",
    "Size", "Courier Status", "Qty", "Amount", "ship-city", "ship-state",
)
NORMALIZED_COLUMNS = {
    "Status": "status", "Fulfilment": "fulfilment", "ship-service-level": "service_level",
    "Style": "style", "SKU": "sku", "Size": "size", "Courier Status": "courier_status",
    "ship-city": "city", "ship-state": "state",
}
PARSED_COLUMNS = {
    "index": ("record_id", long_of_stripped), "Date": ("order_date", date_of_stripped),
    "Qty": ("qty", long_of_stripped), "Amount": ("amount", finite_double_of_stripped),
}

# Normalizing nine columns takes a method of 9200 bytes, four of them 5400.
NORMALIZED_A_STEP = 5

BYTE_ORDER_MARK = "﻿"
RAW_SCHEMA = StructType([StructField(name, StringType()) for name in SALES_COLUMNS])
QUOTING = {"quote": '"', "escape": '"'}
BAD_RECORD = "_bad_record"


def csv_scan(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All 24 columns as nullable text; short records are padded, long ones cut.

    The header of every file is checked for the column names during the scan itself.
    """
    return spark.read.csv(
        path, schema=RAW_SCHEMA, header=True, mode="PERMISSIVE", enforceSchema=False, **QUOTING
    )


def _raw(name: str) -> str:
    """Name of an unparsed field; it differs from the typed columns in more than case."""
    return f"csv {name}"


def _parsed(line: Column) -> Column:
    names = [*map(_raw, SALES_COLUMNS), BAD_RECORD]
    fields = ", ".join(f"`{name}` STRING" for name in names)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD, **QUOTING}
    return F.from_csv(line, fields, options)


def _without_mark(line: Column) -> Column:
    return F.regexp_replace(line, f"^{BYTE_ORDER_MARK}", "")


def is_header(line: Column | str) -> Column:
    """True for a line that opens like the header; a byte order mark may lead."""
    text = as_column(line)
    return text.startswith(HEADER_START) | text.startswith(BYTE_ORDER_MARK + HEADER_START)


def header_contract(lines: DataFrame, line: str = "value") -> DataFrame:
    """Every distinct header line, how often it occurs, and whether it is exactly as required."""
    headers = lines.where(is_header(line)).groupBy(F.col(line).alias("header_line")).agg(
        F.count(F.lit(1)).alias("occurrences")
    )
    fields = _parsed(_without_mark(F.col("header_line")))
    matches = fields[BAD_RECORD].isNull()
    for name in SALES_COLUMNS:
        matches = matches & fields[_raw(name)].eqNullSafe(F.lit(name))
    return headers.withColumn("matches", matches)


def _stripped(name: str) -> str:
    return f"stripped {name}"


def _generated(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed once a row, however often they are used later.

    As plain expressions they would be copied into every expression and filter that uses one of
    them. Each such step is also a generated method of its own; the JVM compiles none of more than
    8000 bytes.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return frame.select("*", F.inline(F.array(row)))


def _parsed_fields(records: DataFrame, field: Callable[[str], str]) -> DataFrame:
    """Records with every text stripped once and every number and date parsed once."""
    texts = _generated(records, {_stripped(n): strip(field(n)) for n in STRIPPED_COLUMNS})
    return _generated(
        texts, {name: parse(_stripped(n)) for n, (name, parse) in PARSED_COLUMNS.items()}
    )


def _typed(parsed: DataFrame, promotions: str, *others: Column | str) -> DataFrame:
    """The typed frame all queries start from, of parsed fields, and other columns after it."""
    names = list(NORMALIZED_COLUMNS)
    for some in (names[:NORMALIZED_A_STEP], names[NORMALIZED_A_STEP:]):
        parsed = _generated(
            parsed, {NORMALIZED_COLUMNS[n]: normalize_stripped(_stripped(n)) for n in some}
        )
    return parsed.select(
        "record_id", blank_to_null(_stripped("Order ID")).alias("order_id"), "order_date",
        "status", "fulfilment", "service_level", "style", "sku", "size", "courier_status", "qty",
        "amount", "city", "state", F.col(promotions).alias("promotion_ids_raw"),
        month_key("order_date").alias("month"), is_bought("status", "qty").alias("is_bought"),
        *others,
    )


def read_sales(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Typed frame of every record; a value that does not parse becomes null."""
    raw = csv_scan(spark, path).withColumnsRenamed({name: _raw(name) for name in SALES_COLUMNS})
    return _typed(_parsed_fields(raw, _raw), _raw("promotion-ids"))


def _malformed_quotes(line: Column) -> Column:
    """True where a quoted field is not closed, or is followed by more than blanks.

    Escaped quotes go first, then well-formed quoted fields; a quote that still opens a
    field is malformed.
    """
    unescaped = F.replace(line, F.lit('""'), F.lit(""))
    remainder = F.regexp_replace(unescaped, '(^|,)"[^"]*"[ \\t]*(?=,|$)', "$1")
    return F.when(line.contains('"'), remainder.rlike('(^|,)"')).otherwise(F.lit(False))


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Typed columns of every line plus ``is_header``, ``reject_field``, ``reject_reason``.

    The first failing check names the reject: column count and quoting, then index, Order
    ID, Date, Status, Fulfilment, ship-service-level, Qty, Amount.
    """
    text = F.col(line)
    record = lines.select(
        text.alias("line"), is_header(text).alias("is_header"), F.inline(F.array(_parsed(text)))
    )
    checked = _generated(_parsed_fields(record, _raw), {"reject": _reject()})
    return _typed(
        checked, _raw("promotion-ids"), "line", "is_header",
        token_array(F.col(_raw("promotion-ids"))).alias("promotion_ids"),
        F.col("reject.field").alias("reject_field"),
        F.col("reject.reason").alias("reject_reason"),
    )


def _reject() -> Column:
    """Field and reason of the first failing check of a parsed record; null for a header."""
    def blank(name: str) -> Column:
        return F.coalesce(F.length(_stripped(name)), F.lit(0)) == 0

    structure = (
        F.col(BAD_RECORD).isNotNull() | (F.length("line") == 0) | _malformed_quotes(F.col("line"))
    )
    checks = [(structure, "csv", "structure")]
    for name in REQUIRED_COLUMNS:
        checks.append((blank(name), name, "missing"))
        if name in PARSED_COLUMNS:
            checks.append((F.col(PARSED_COLUMNS[name][0]).isNull(), name, "invalid"))
    checks.append((~blank("Amount") & F.col("amount").isNull(), "Amount", "invalid"))
    first = F.coalesce(*[
        F.when(failed, F.struct(F.lit(name).alias("field"), F.lit(reason).alias("reason")))
        for failed, name, reason in checks
    ])
    return F.when(~F.col("is_header"), first)


def typed_ingest(
    lines: DataFrame, line: str = "value", staged: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Valid typed rows, and rejected lines with the field and the reason.

    The parsed lines are staged, so that both frames come from one parse; without ``staged``
    each of them parses the lines again.
    """
    parsed = parse_lines(lines, line).where(~F.col("is_header"))
    if staged:
        kept = F.when(F.col("reject_field").isNotNull(), F.col("line"))
        parsed = stage(parsed.withColumn("line", kept), "parsed-lines")
    valid = parsed.where(F.col("reject_field").isNull()).drop(
        "line", "is_header", "reject_field", "reject_reason"
    )
    rejects = parsed.where(F.col("reject_field").isNotNull()).select(
        "line", "reject_field", "reject_reason"
    )
    return valid, rejects


def outcome(keys: list[str]) -> Column:
    """What becomes of a parsed line when ``keys`` are required."""
    return (
        F.when(F.col("is_header"), "header")
        .when(F.col("reject_field").isNotNull(), F.concat(F.lit("rejected:"), "reject_field"))
        .when(~F.col("is_bought"), "not_bought")
        .when(reduce(Column.__or__, [F.col(k).isNull() for k in keys]), "missing_key")
        .otherwise("accepted")
    )


def ingest_outcome_counts(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """Lines per outcome, and all lines as ``rows_read``, in one pass."""
    counts = parsed.select(outcome(keys).alias("outcome")).rollup("outcome").agg(
        F.count(F.lit(1)).alias("rows")
    )
    return counts.select(
        F.coalesce("outcome", F.lit("rows_read")).alias("outcome"), "rows"
    )
