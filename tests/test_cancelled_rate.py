import datetime as dt

import pytest

from tallyframe.operators.tokens import (
    distinct_tokens,
    lifespans,
    per_record_counts,
    temporally_valid_tokens,
    tokens,
    with_token_count,
)
from tallyframe.plans.cancelled_rate import conditional_rate_by_city

SCHEMA = (
    "record_id bigint, order_date date, status string, service_level string, fulfilment string, "
    "courier_status string, state string, city string, amount double, promotion_ids_raw string"
)
FIRST, SECOND, THIRD = (dt.date(2022, 4, d) for d in (1, 2, 3))


def cancelled(i, promotions, amount=10.0, city="C1", state="S1", day=THIRD):
    return (i, day, "CANCELLED", "STANDARD", "AMAZON", "UNSHIPPED", state, city, amount, promotions)


def shipped(i, amount, state="S1", promotions=None, day=FIRST, fulfilment="MERCHANT"):
    return (i, day, "SHIPPED", "EXPEDITED", fulfilment, "SHIPPED", state, "C9", amount, promotions)


# P1 to P3 live from the first to the third of April, Q only from the second to the third.
LIVES = [
    shipped(100, 20.0, promotions="P1,P2,P3"), shipped(101, 40.0, promotions="Q", day=SECOND),
    shipped(102, None), shipped(103, 1000.0, fulfilment="AMAZON"),
]


def frame(spark, rows):
    return spark.createDataFrame(LIVES + rows, SCHEMA)


CASES = [
    ("three long-lived", cancelled(1, "P1, P2 ,P3"), 1),
    ("repeats and blanks do not add up", cancelled(1, "P1,P2,P2,, "), 0),
    ("a short-lived one does not count", cancelled(1, "P1,P2,Q"), 0),
    ("amount equal to the average", cancelled(1, "P1,P2,P3", amount=30.0), 0),
    ("amount just below", cancelled(1, "P1,P2,P3", amount=29.99), 1),
    ("no amount", cancelled(1, "P1,P2,P3", amount=None), 0),
    ("state without average", cancelled(1, "P1,P2,P3", state="S2"), 0),
    ("no promotions", cancelled(1, None), 0),
]


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("label, row, qualifying", CASES, ids=[c[0] for c in CASES])
def test_single_order(spark, label, row, qualifying, unique):
    # Another state's order keeps P1 to P3 alive on the third of April.
    keep_alive = cancelled(50, "P1,P2,P3", state="S9", city="C9")
    result = conditional_rate_by_city(frame(spark, [row, keep_alive]), unique_records=unique)
    rows = {(r.state, r.city): tuple(r)[2:] for r in result.collect()}
    assert rows[row[6], row[7]] == (1, qualifying, 100.0 * qualifying)


def test_groups_by_state_and_city(spark):
    rows = [
        cancelled(1, "P1,P2,P3"), cancelled(2, None), cancelled(3, "P1,P2,P3", state="S2"),
        cancelled(4, "P1,P2,P3", city=None), cancelled(5, "P1,P2,P3", state=None),
    ]
    result = [tuple(r) for r in conditional_rate_by_city(frame(spark, rows)).collect()]
    assert result == [("S1", "C1", 2, 1, 50.0), ("S2", "C1", 1, 0, 0.0)]


@pytest.mark.parametrize("strategy", [None, "broadcast", "merge", "shuffle_hash"])
@pytest.mark.parametrize("staged", [True, False])
def test_strategy_does_not_change_the_result(spark, strategy, staged):
    rows = [cancelled(i, "P1,P2,P3" if i % 3 else "P1", city=f"C{i % 4}") for i in range(40)]
    result = conditional_rate_by_city(frame(spark, rows), strategy=strategy, staged=staged)
    expected = {f"C{c}": [i for i in range(40) if i % 4 == c] for c in range(4)}
    assert [(r.city, r.cancelled_standard_orders, r.qualifying_orders) for r in result.collect()] == [
        (c, len(ids), sum(1 for i in ids if i % 3)) for c, ids in sorted(expected.items())
    ]


def test_repeated_record_ids_count_tokens_together(spark):
    rows = [cancelled(1, "P1,P2"), cancelled(1, "P2,P3"), cancelled(2, "P1")]
    result = conditional_rate_by_city(frame(spark, rows), unique_records=False).collect()
    assert [tuple(r)[2:4] for r in result] == [(3, 2)]


@pytest.mark.parametrize("unique", [True, False])
def test_orders_without_record_id_never_qualify(spark, unique):
    rows = [cancelled(None, "P1,P2"), cancelled(None, "P2,P3"), cancelled(2, "P1,P2,P3")]
    result = conditional_rate_by_city(frame(spark, rows), unique_records=unique).collect()
    assert [tuple(r)[2:4] for r in result] == [(3, 1)]


def test_no_promotions_required(spark):
    rows = [cancelled(1, None), cancelled(2, "P1"), cancelled(3, None, amount=99.0)]
    result = conditional_rate_by_city(frame(spark, rows), min_promotions=0).collect()
    assert [tuple(r)[2:4] for r in result] == [(3, 2)]


def test_lifespans(spark):
    rows = [(1, FIRST, "A,B"), (2, THIRD, "A, A"), (3, None, "B,C"), (4, SECOND, "")]
    base = spark.createDataFrame(rows, "record_id bigint, order_date date, promotion_ids_raw string")
    result = {r.promotion_id: tuple(r)[1:] for r in lifespans(tokens(base)).collect()}
    assert result == {"A": (FIRST, THIRD, 2, 2), "B": (FIRST, FIRST, 1, 0)}
    for staged in (True, False):
        valid = temporally_valid_tokens(base, staged=staged).collect()
        assert sorted((r.record_id, r.promotion_id) for r in valid) == [(1, "A"), (2, "A")]
    counts = {r.record_id: r.promotion_count for r in per_record_counts(base).collect()}
    assert counts == {1: 2, 2: 1, 3: 2, 4: 0}


@pytest.mark.parametrize("unique, scans", [(True, 1), (False, 2)])
def test_rows_are_scanned_once_or_twice(spark, unique, scans):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [cancelled(i, "P1,P2,P3") for i in range(20)]
    base = frame(spark, rows).repartition(3)
    result = conditional_rate_by_city(base.mapInArrow(counted, SCHEMA), unique_records=unique)
    assert [tuple(r)[2:4] for r in result.collect()] == [(20, 20)]
    # the column pruning of a lookup could drop a scan, never add one
    assert read.value == scans * (len(LIVES) + len(rows))


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("minimum, qualifying", [(0, 2), (1, 1), (3, 1), (4, 0)])
def test_number_of_promotions_asked_for(spark, unique, minimum, qualifying):
    rows = [cancelled(1, "P1,P2,P3"), cancelled(2, None), cancelled(3, None, amount=None)]
    result = conditional_rate_by_city(frame(spark, rows), min_promotions=minimum, unique_records=unique)
    assert [tuple(r)[2:4] for r in result.collect()] == [(3, qualifying)]


def test_empty_base_and_missing_record_ids(spark):
    assert conditional_rate_by_city(frame(spark, []).where("false")).count() == 0
    rows = [cancelled(None, "P1,P2,P3"), cancelled(2, "P1,P2,P3")]
    for unique in (True, False):
        result = conditional_rate_by_city(frame(spark, rows), unique_records=unique)
        assert [tuple(r)[2:4] for r in result.collect()] == [(2, 1)]


def test_only_the_tokens_of_candidates_are_split_a_second_time(spark):
    rates = conditional_rate_by_city(frame(spark, [cancelled(1, "P1,P2,P3")]), staged=False)
    plan = rates._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan[plan.index("array_distinct"):]


@pytest.mark.parametrize("staged", [True, False])
def test_tokens_of_repeated_records_are_counted_without_a_hash_table_of_all(spark, staged):
    rows = [
        shipped(1, 1.0, promotions="A,B"), shipped(1, 2.0, promotions="B, C,"), shipped(2, 3.0),
        shipped(None, 4.0, promotions="A"),
    ]
    base = spark.createDataFrame(rows, SCHEMA)
    counted = with_token_count(base, staged=staged)
    assert {(r.record_id, r.amount): r.promotion_count for r in counted.collect()} == {
        (1, 1.0): 3, (1, 2.0): 3, (2, 3.0): 0, (None, 4.0): 0,
    }
    plan = distinct_tokens(base)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan
