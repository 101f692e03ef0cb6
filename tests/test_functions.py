import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import arrays, sales, text


def values(spark, inputs, expression, type_="string"):
    """The expression over column ``v``, in input order."""
    rows = spark.createDataFrame(list(enumerate(inputs)), f"i int, v {type_}")
    return [r.x for r in rows.select("i", expression.alias("x")).orderBy("i").collect()]


def test_normalize_dimension(spark):
    inputs = ["  red   widget ", "a\tb\n c", "\x01x\x02", "", " \t ", None, "Abc", "a \x0b b"]
    expected = ["RED WIDGET", "A B C", "X", None, None, None, "ABC", "A B"]
    assert values(spark, inputs, text.normalize_dimension("v")) == expected


def test_clean_text_keeps_case_and_inner_blanks(spark):
    inputs = ["\t A  b \n", " ", None]
    assert values(spark, inputs, text.clean_text("v")) == ["A  b", None, None]


def test_normalized_equals(spark):
    inputs = [" standard ", "Standard x", None, ""]
    result = values(spark, inputs, text.normalized_equals("v", "Standard"))
    assert result == [True, False, False, False]


def test_strict_date(spark):
    inputs = ["04-30-22", " 04-30-22\t", "02-30-22", "4-5-22", "04-30-2022", "02-29-24", "", None]
    good = dt.date(2022, 4, 30)
    expected = [good, good, None, None, None, dt.date(2024, 2, 29), None, None]
    assert values(spark, inputs, text.strict_date("v")) == expected


def test_month_key(spark):
    assert values(spark, ["04-30-22"], text.month_key(text.strict_date("v"))) == ["2022-04"]


def test_numbers(spark):
    whole = ["5", " -5\t", "+5", "5.0", "x", "", None, "99999999999999999999"]
    assert values(spark, whole, text.to_long("v")) == [5, -5, 5, None, None, None, None, None]
    finite = ["1.5", " 1e3", "NaN", "Infinity", "-inf", "x", None]
    expected = [1.5, 1000.0, None, None, None, None, None]
    assert values(spark, finite, text.to_finite_double("v")) == expected


@pytest.mark.parametrize("status, qty, bought", [
    ("Shipped", 1, True), ("Shipped - Returned to Seller", 2, True), ("SHIPPED", 0, False),
    ("Shipped", -1, False), ("Shipping", 1, False), ("Cancelled", 1, False), (None, 1, False),
    ("shipped", None, False),
])
def test_is_bought(spark, status, qty, bought):
    row = spark.createDataFrame([(status, qty)], "s string, q bigint")
    assert bool(row.select(sales.is_bought("s", "q")).first()[0]) is bought


SIZES = {
    "XXL": (True, 6), "xxxl": (True, 7), "3XL": (True, 7), " 6 xl": (True, 10),
    "10XL": (True, 14), "2XL": (True, 6), "XL": (False, 5), "1XL": (False, 5), "L": (False, 4),
    "M": (False, 3), "S": (False, 2), "XS": (False, 1), "FREE": (False, None), "0XL": (False, None),
    "": (False, None), "XXLX": (False, None), None: (False, None), "9223372036854775807XL": (True, None),
}


def test_sizes(spark):
    inputs = list(SIZES)
    assert values(spark, inputs, sales.is_at_least_xxl("v")) == [SIZES[s][0] for s in inputs]
    assert values(spark, inputs, sales.size_rank("v")) == [SIZES[s][1] for s in inputs]


def test_below_reference_flag_is_null_safe(spark):
    rows = [(3, 1.0, 2.0), (2, 1.0, 2.0), (3, 2.0, 2.0), (3, None, 2.0), (3, 1.0, None),
            (None, 1.0, 2.0)]
    frame = spark.createDataFrame(rows, "c bigint, a double, r double")
    flags = [r[0] for r in frame.select(sales.below_reference_flag("c", "a", "r")).collect()]
    assert flags == [True, False, False, False, False, False]


def test_token_array_and_count(spark):
    inputs = ["b, a ,b,, \tA\n", None, " , ,", "x"]
    expected = [["b", "a", "A"], [], [], ["x"]]
    assert values(spark, inputs, arrays.token_array("v")) == expected
    assert values(spark, inputs, arrays.token_count("v")) == [3, 0, 0, 1]


def test_following_days_crosses_month_end(spark):
    day = F.to_date(F.col("v"))
    result = values(spark, ["2022-06-29"], arrays.following_days(day, 3))[0]
    assert result == [dt.date(2022, 6, 30), dt.date(2022, 7, 1), dt.date(2022, 7, 2)]


def test_quick_strip_is_strip(spark):
    inputs = ["", " ", "\t", "a", " a ", "\ta", "a\n", " \x01a", "a \x00 ", " a\tb ", "\u00a0a\u00a0", "!", None]
    assert values(spark, inputs, text.quick_strip("v")) == values(spark, inputs, text.strip("v"))
