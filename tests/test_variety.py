import datetime as dt

import pytest

from tallyframe.plans.variety_median import variety_median, variety_scope_comparison

SCHEMA = "state string, order_date date, status string, qty bigint, style string, sku string, size string"
APRIL, MAY = dt.date(2022, 4, 2), dt.date(2022, 5, 3)


def sales(spark, rows):
    full = [(state, d, "Shipped", 1, style, sku, size) for state, d, style, sku, size in rows]
    return spark.createDataFrame(full, SCHEMA)


ROWS = [
    ("A", APRIL, "T1", "T1-1", "XXL"), ("A", APRIL, "T1", "T1-1", "M"), ("A", APRIL, "T1", "t1-2 ", "S"),
    ("A", APRIL, "T2", "T2-1", "M"),
    ("A", APRIL, "T3", "T3-1", "XL"),
    ("B", MAY, "T2", "T2-1", "3XL"), ("B", MAY, "T2", "T2-2", "M"), ("B", MAY, "T2", "T2-3", "M"),
    ("C", MAY, "T3", "T3-1", "1XL"), ("C", MAY, "T3", "T3-2", "FREE"),
]


def rows_of(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.mark.parametrize("staged", [True, False])
def test_global_scope(spark, staged):
    """A style that sold a large size elsewhere counts; groups without one give no row."""
    result = rows_of(variety_median(sales(spark, ROWS), staged=staged))
    assert result == [("A", "2022-04", 1.5, 2), ("B", "2022-05", 3.0, 1)]


def test_group_scope(spark):
    result = rows_of(variety_median(sales(spark, ROWS), scope="group"))
    assert result == [("A", "2022-04", 2.0, 1), ("B", "2022-05", 3.0, 1)]


def test_scope_comparison_keeps_groups_without_local_styles(spark):
    rows = [*ROWS, ("D", APRIL, "T1", "T1-9", "M")]
    result = rows_of(variety_scope_comparison(sales(spark, rows)))
    assert result == [
        ("A", "2022-04", 1.5, 2, 2.0, 1), ("B", "2022-05", 3.0, 1, 3.0, 1),
        ("D", "2022-04", 1.0, 1, None, None),
    ]


def test_odd_and_even_medians(spark):
    def style(name, n):
        return [("A", APRIL, name, f"{name}-{i}", "XXL") for i in range(n)]

    odd = style("X", 1) + style("Y", 5) + style("Z", 2)
    assert rows_of(variety_median(sales(spark, odd))) == [("A", "2022-04", 2.0, 3)]
    even = odd + style("W", 9)
    assert rows_of(variety_median(sales(spark, even))) == [("A", "2022-04", 3.5, 4)]


def test_rows_without_state_or_sku_still_qualify_their_style(spark):
    rows = [
        (None, APRIL, "T1", "T1-1", "XXL"), ("A", APRIL, "T1", "T1-2", "M"),
        ("A", APRIL, "T2", None, "XXL"), ("B", APRIL, "T2", "T2-1", "S"),
    ]
    result = rows_of(variety_median(sales(spark, rows)))
    assert result == [("A", "2022-04", 1.0, 1), ("B", "2022-04", 1.0, 1)]


def test_empty_and_unknown_scope(spark):
    assert rows_of(variety_median(sales(spark, ROWS).where("1 = 0"))) == []
    with pytest.raises(ValueError, match="scope"):
        variety_median(sales(spark, ROWS), scope="state")
