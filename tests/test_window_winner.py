import datetime as dt
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyframe.operators.moments import (
    finished_moments,
    group_moments,
    mean_value,
    population_variance,
)
from tallyframe.operators.windows import difference_window_moments
from tallyframe.plans.window_winner import dynamic_window_winner

SCHEMA = "state string, order_date date, status string, qty bigint, size string, amount double"
D = dt.date(2022, 4, 10)


def day(n):
    return D + dt.timedelta(days=n)


def sales(spark, rows):
    """Rows of (state, day number, size, amount), all sold."""
    full = [(state, day(n), "Shipped", 1, size, amount) for state, n, size, amount in rows]
    return spark.createDataFrame(full, SCHEMA)


def winners(frame, **options):
    rows = dynamic_window_winner(frame, **options).collect()
    return {(r.state, (r.window_date - D).days): tuple(r)[2:] for r in rows}


def brute_force(rows, limit):
    """Winner per (state, day) straight from the definition."""
    volume, moments = defaultdict(int), defaultdict(list)
    for state, *_ in rows:
        volume[state] += 1
    for state, n, size, amount in rows:
        days = 5 if volume[state] > limit else 10
        for window in range(n + 1, n + days + 1):
            moments[state, window, days, size].append(amount)
    best = {}
    for (state, window, days, size), amounts in moments.items():
        cents = [round(a * 100) for a in amounts if a is not None]
        variance = None
        if cents:
            mean = Fraction(sum(cents), len(cents))
            variance = sum((c - mean) ** 2 for c in cents) / len(cents) / 10000
        rank = (-len(amounts), variance is None, variance or 0, size)
        if (state, window) not in best or rank < best[state, window][0]:
            best[state, window] = (rank, (days, size, len(amounts), variance))
    return {key: value for key, (_, value) in best.items()}


def assert_same(actual, expected):
    assert actual.keys() == expected.keys()
    for key, (days, size, count, variance) in expected.items():
        assert actual[key][:3] == (days, size, count), key
        if variance is None:
            assert actual[key][3] is None
        else:
            assert actual[key][3] == pytest.approx(float(variance), rel=1e-12, abs=1e-12)


def random_rows(seed, n=400):
    chance = random.Random(seed)
    # One state holds most of the rows, and amounts repeat so that ties occur.
    return [
        (chance.choice(["A", "A", "A", "B", "C"]), chance.randrange(25),
         chance.choice(["S", "M", "L"]), chance.choice([None, 10.0, 20.5, 99.99]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("options", [
    {}, {"staged": False}, {"window_moments": difference_window_moments},
])
def test_matches_brute_force(spark, options):
    rows = random_rows(7)
    frame = sales(spark, rows).repartition(5)
    assert_same(winners(frame, limit=150, **options), brute_force(rows, 150))


def test_window_excludes_the_day_itself_and_reaches_past_the_last_day(spark):
    result = winners(sales(spark, [("A", 0, "M", 1.0)]))
    assert sorted(n for _, n in result) == list(range(1, 11))


def test_volume_limit_is_exclusive(spark):
    at_limit = [("A", 0, "M", 1.0)] * 4
    assert {v[0] for v in winners(sales(spark, at_limit), limit=4).values()} == {10}
    above = at_limit + [("A", 0, None, 1.0)]
    assert {v[0] for v in winners(sales(spark, above), limit=4).values()} == {5}


def test_volume_counts_over_ten_thousand(spark):
    frame = spark.range(10_001).select(
        F.when(F.col("id") < 1, "A").otherwise("B").alias("state"), F.lit(D).alias("order_date"),
        F.lit("Shipped").alias("status"), F.lit(1).cast("bigint").alias("qty"),
        F.lit("M").alias("size"), F.lit(1.0).alias("amount"),
    )
    both = frame.unionByName(frame.where("id = 1"))
    days = {state: value[0] for (state, _), value in winners(both).items()}
    assert days == {"A": 10, "B": 5}
    assert {v[0] for (s, _), v in winners(frame).items() if s == "B"} == {10}


def test_ties(spark):
    lower_variance = [("A", 0, "L", 1.0), ("A", 0, "L", 2.0), ("A", 0, "M", 1.0), ("A", 0, "M", 1.5)]
    assert winners(sales(spark, lower_variance))["A", 1] == (10, "M", 2, 0.0625)
    smaller_label = [("A", 0, "M", 3.0), ("A", 0, "L", 9.0)]
    assert winners(sales(spark, smaller_label))["A", 1] == (10, "L", 1, 0.0)
    undefined_loses = [("A", 0, "L", None), ("A", 0, "M", 5.0)]
    assert winners(sales(spark, undefined_loses))["A", 1] == (10, "M", 1, 0.0)
    undefined_wins_by_count = [("A", 0, "L", None), ("A", 0, "L", None), ("A", 0, "M", 5.0)]
    assert winners(sales(spark, undefined_wins_by_count))["A", 1] == (10, "L", 2, None)


def test_unsold_rows_and_missing_keys(spark):
    rows = [
        ("A", D, "Shipping", 1, "M", 1.0), ("A", D, "Shipped", 0, "M", 1.0),
        ("A", D, "Shipped", -1, "M", 1.0), (None, D, "Shipped", 1, "M", 1.0),
        (" ", D, "Shipped", 1, "M", 1.0), ("A", D, "Shipped", 1, None, 1.0),
        ("A", None, "Shipped", 1, "M", 1.0),
    ]
    assert winners(spark.createDataFrame(rows, SCHEMA)) == {}
    mixed = [(" a  b ", D, "shipped", 1, "m", 1.0), ("A B", D, "SHIPPED", 1, " M", 1.0)]
    assert winners(spark.createDataFrame(mixed, SCHEMA))["A B", 1] == (10, "M", 2, 0.0)


def test_result_does_not_depend_on_order_or_partitions(spark):
    rows = random_rows(3)
    one = winners(sales(spark, rows).coalesce(1), limit=150)
    assert winners(sales(spark, rows[::-1]).repartition(13), limit=150) == one


def test_moments_are_exact_for_large_and_negative_amounts(spark):
    amounts = [30_000_000.01, -45_000_000_000.99, 0.01, None, 12345678.9, -0.02]
    frame = spark.createDataFrame([("g", a) for a in amounts], "k string, a double")
    grouped = group_moments(frame, ["k"], "a")
    row = finished_moments(grouped).first()
    cents = [round(a * 100) for a in amounts if a is not None]
    assert (row.row_count, row.value_count, row.value_sum) == (6, 5, sum(cents))
    assert int(row.value_square_sum) == sum(c * c for c in cents)
    mean = Fraction(sum(cents), 5)
    expected = float(sum((c - mean) ** 2 for c in cents) / 5 / 10000)
    result = grouped.select(population_variance().alias("v"), mean_value().alias("m")).first()
    assert result.v == pytest.approx(expected, rel=1e-14)
    assert result.m == pytest.approx(float(mean / 100), rel=1e-14)


def test_variance_beyond_38_digits_fails(spark):
    grouped = spark.sql("""
        SELECT 1000000000000L AS row_count, 1000000000000L AS value_count,
               5000000000000000000L AS value_sum, 0L AS square_units, 0L AS square_blocks,
               0L AS square_cross, 9000000000000L AS square_high""")
    with pytest.raises(Exception, match="38 digits"):
        grouped.select(population_variance()).first()


def test_variance_of_large_amounts_close_together(spark):
    amounts = [9e13 + k / 100 for k in (0, 1, 4, 9)]
    frame = spark.createDataFrame([("g", x) for x in amounts] * 100, "k string, x double")
    variance = group_moments(frame, ["k"], "x").select(population_variance()).first()[0]
    units = [Fraction(round(x * 100)) for x in amounts]
    mean = sum(units) / 4
    assert variance == pytest.approx(float(sum((u - mean) ** 2 for u in units) / 4 / 10_000), rel=1e-12)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("amount", [1.001, float("nan"), float("inf"), 1e17])
def test_inexact_amounts_fail(spark, ansi, amount):
    frame = spark.createDataFrame([("g", 1.0), ("g", amount)], "k string, x double")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="whole number"):
            group_moments(frame, ["k"], "x").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_never_wrap(spark, ansi):
    frame = spark.createDataFrame([("g", 9e13)] * 1030, "k string, x double")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="64 bits"):
            group_moments(frame, ["k"], "x").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_ties_below_a_cent_need_a_larger_scale(spark):
    rows = [("S", 0, "A", 1.001), ("S", 0, "A", 1.004), ("S", 0, "L", 1.0), ("S", 0, "L", 1.0)]
    found = winners(sales(spark, rows), scale=3)
    assert found["S", 1][1:3] == ("L", 2) and found["S", 1][3] == 0.0
    with pytest.raises(Exception, match="whole number"):
        winners(sales(spark, rows))


def test_no_window_gathers_rows_of_a_group(spark):
    """The winner plan has no window function, and nothing but the winner sorts."""
    frame = sales(spark, random_rows(1))
    plan = dynamic_window_winner(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Python" not in plan
