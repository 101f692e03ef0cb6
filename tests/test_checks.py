import datetime as dt

import pytest

from tallyframe.operators.checks import check_all, violations
from tallyframe.operators.compare import keyed_difference, set_difference_counts
from tallyframe.operators.keys import existing_values, lookup_join, missing_key_counts
from tallyframe.plans.validation import (
    cancelled_rate_contract,
    percentile_bands_contract,
    validate_results,
    variety_median_contract,
    window_winner_contract,
)

DAY = dt.date(2022, 4, 1)
NAN = float("nan")


def found(spark, contract, rows, schema=None):
    frame = spark.createDataFrame(rows, schema or contract.schema)
    return sorted((r.rule, r.row_key) for r in violations(frame, contract).collect())


def test_window_winner(spark):
    contract = window_winner_contract()
    good = [("A", DAY, 5, "M", 1, 0.0), ("B", DAY, 10, "M", 1, None)]
    assert found(spark, contract, good) == []
    bad = [("A", DAY, 7, "M", 1, 0.0), ("B", DAY, 5, "M", 0, -1.0), ("C", DAY, 5, "M", 1, NAN),
           ("D", DAY, 5, "M", 1, 1.0), ("D", DAY, 5, "L", 1, 1.0)]
    assert found(spark, contract, bad) == [
        ("frequency", "B|2022-04-01"), ("population_variance", "B|2022-04-01"),
        ("population_variance", "C|2022-04-01"), ("unique_key", "D|2022-04-01"),
        ("window_days", "A|2022-04-01"),
    ]


def test_variety_median(spark):
    bad = [("A", "2022-4", 1.0, 1), ("B", "2022-04", 0.5, 1), ("C", "2022-04", None, 0)]
    assert found(spark, variety_median_contract(), bad) == [
        ("median_variety", "B|2022-04"), ("median_variety", "C|2022-04"), ("month", "A|2022-4"),
        ("qualifying_style_count", "C|2022-04"),
    ]


def test_cancelled_rate(spark):
    bad = [("A", "x", 2, 1, 50.0), ("A", None, 1, 0, 0.0), ("B", "x", 0, 0, 0.0),
           ("C", "x", 1, 2, 200.0), ("D", "x", 1, 0, NAN)]
    assert found(spark, cancelled_rate_contract(), bad) == [
        ("cancelled_standard_orders", "B|x"), ("keys_present", "A|NULL"), ("percentage", "C|x"),
        ("percentage", "D|x"), ("qualifying_orders", "C|x"),
    ]


def test_percentile_bands(spark):
    four = [("A", "m", method, level, 1.0, 2, 1, 0.0)
            for method in ("approx", "exact") for level in ("P80", "P90")]
    contract = percentile_bands_contract()
    assert found(spark, contract, four) == []
    assert found(spark, contract, four[:3]) == [("multiplicity", "A|m")]
    bad = [*four[:3], ("A", "m", "guess", "P90", -1.0, 1, 2, NAN)]
    assert {rule for rule, _ in found(spark, contract, bad)} == {
        "method", "threshold", "amount_value_count", "amount_stddev_pop",
    }


def test_wrong_schema_is_the_only_report(spark):
    schema = "state string, city string, cancelled_standard_orders int, qualifying_orders bigint"
    result = found(spark, cancelled_rate_contract(), [("A", "x", 0, 5)], schema)
    assert result == [("schema", "column 2"), ("schema", "column 4")]


def test_validate_results_joins_all_reports(spark):
    winner = spark.createDataFrame([("A", DAY, 7, "M", 1, 0.0)], window_winner_contract().schema)
    median = spark.createDataFrame([("A", "x", 1.0, 1)], variety_median_contract().schema)
    rate = spark.createDataFrame([], cancelled_rate_contract().schema)
    bands = spark.createDataFrame([], percentile_bands_contract().schema)
    result = validate_results(winner, median, rate, bands).collect()
    assert sorted((r.result, r.rule) for r in result) == [
        ("variety_median", "month"), ("window_winner", "window_days"),
    ]


def test_keyed_difference_is_a_bag(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    right = spark.createDataFrame([("b",), ("c",)], "k string")
    rows = keyed_difference(left, right, ["k"], "l", "r")
    assert sorted(map(tuple, rows.collect())) == [("a", "l"), ("a", "l"), ("c", "r")]
    counts = {r.k: (r.l_count, r.r_count) for r in set_difference_counts(rows, ["k"], "l", "r").collect()}
    assert counts == {"a": (2, 0), "c": (0, 1)}


def test_forced_strategy_is_the_one_that_runs(spark):
    facts, lookup = spark.range(50), spark.range(20)
    for strategy, node in (
        ("broadcast", "BroadcastHashJoin"), ("merge", "SortMergeJoin"),
        ("shuffle_hash", "ShuffledHashJoin"),
    ):
        joined = lookup_join(facts, lookup, ["id"], strategy=strategy)
        assert joined.count() == 20
        assert node in joined._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="strategy"):
        lookup_join(facts, lookup, ["id"], strategy="nested")


def test_keyed_difference_reads_each_side_once_and_matches_null_keys(spark):
    left = spark.createDataFrame([("a", None), (None, 1), (None, None)], "k string, n int")
    right = spark.createDataFrame([("a", None), (None, None), ("b", 2)], "k string, n int")
    rows = keyed_difference(left, right, ["k", "n"], "l", "r")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, map(tuple, rows.collect()))) == ["('b', 2, 'r')", "(None, 1, 'l')"]
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_existing_values(spark):
    frame = spark.createDataFrame([("a",), (None,)], "k string")
    found = {row["k"]: row["found"] for row in existing_values(frame, "k", ["a", "b"]).collect()}
    assert found == {"a": True, "b": False}
    none = existing_values(frame.limit(0), "k", ["a", "b"]).collect()
    assert [row["found"] for row in none] == [False, False]


def test_missing_key_counts(spark):
    frame = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "x int, y string")
    assert tuple(missing_key_counts(frame, ["x", "y"]).first()) == (1, 2)


def test_keys_that_read_alike_are_not_equal(spark):
    contract = cancelled_rate_contract()
    rows = [("a|b", "c", 1, 0, 0.0), ("a", "b|c", 1, 0, 0.0), ("NULL", "x", 1, 0, 0.0)]
    assert found(spark, contract, rows) == []
    twice = [("a", "x", 0, 0, 0.0), ("a", "x", 0, 0, 0.0)]
    assert found(spark, contract, twice) == [
        ("cancelled_standard_orders", "a|x"), ("cancelled_standard_orders", "a|x"), ("unique_key", "a|x"),
    ]
    assert found(spark, contract, []) == []


def test_a_result_is_scanned_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    contract = percentile_bands_contract()
    rows = [("A", "m", m, p, 1.0, 2, 1, 0.0) for m in ("approx", "exact", "exact") for p in ("P80", "P90")]
    frame = spark.createDataFrame(rows, contract.schema).repartition(2).mapInArrow(counted, contract.schema)
    result = sorted((r.rule, r.row_key) for r in check_all([(frame, contract)]).collect())
    assert result == [("multiplicity", "A|m"), ("unique_key", "A|m|exact|P80"), ("unique_key", "A|m|exact|P90")]
    assert read.value == len(rows)
