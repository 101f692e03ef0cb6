import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.operators.percentiles import (
    approx_percentiles,
    exact_percentiles,
    with_group_size,
)
from tallyframe.operators.profile import group_size_profile, mean_and_sample_sd
from tallyframe.plans.percentile_bands import (
    KEYS,
    VALUE,
    amount_histogram,
    compare_methods,
    ordered_band_stats,
    percentile_band_stats,
    set_difference_examples,
    sku_month_base,
    sku_month_profile,
)

SCHEMA = "record_id bigint, sku string, month string, promotion_count bigint, amount double"


def base(spark, groups):
    """``groups`` maps a SKU to its (promotion count, amount) rows."""
    rows = []
    for sku, pairs in groups.items():
        rows += [(len(rows) + i, sku, "2022-04", n, a) for i, (n, a) in enumerate(pairs)]
    return spark.createDataFrame(rows, SCHEMA)


def stats(frame):
    return {(r.sku, r.method, r.percentile_level): tuple(r)[4:] for r in frame.collect()}


def brute_force(groups, levels):
    result = {}
    for sku, pairs in groups.items():
        counts = sorted(n for n, _ in pairs)
        for level, p in levels.items():
            threshold = counts[math.ceil(p * len(counts)) - 1]
            amounts = [a for n, a in pairs if n >= threshold]
            known = [a for a in amounts if a is not None]
            deviation = 0.0
            if len(amounts) >= 2 and known:
                mean = sum(known) / len(known)
                deviation = math.sqrt(sum((a - mean) ** 2 for a in known) / len(known))
            result[sku, level] = (float(threshold), len(amounts), len(known), deviation)
    return result


def random_groups(seed):
    chance = random.Random(seed)
    sizes = {"A": 600, "B": 1, "C": 2, "D": 5, "E": 10, "F": 37}
    return {
        sku: [(chance.choice([0, 0, 1, 1, 2, 3, 5, 9, 26]),
               chance.choice([None, round(chance.uniform(0, 2000), 2)])) for _ in range(n)]
        for sku, n in sizes.items()
    }


def test_nearest_rank_of_the_documented_group(spark):
    counts = [0, 0, 1, 1, 2, 2, 2, 3, 5, 9]
    result = stats(percentile_band_stats(base(spark, {"A": [(n, 1.0) for n in counts]}), "exact"))
    assert result["A", "exact", "P80"][0] == 3.0
    assert result["A", "exact", "P90"][:2] == (5.0, 2)


@pytest.mark.parametrize("method", ["exact", "approx", "both"])
@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, method, seed):
    groups = random_groups(seed)
    result = stats(percentile_band_stats(base(spark, groups).repartition(7), method))
    expected = brute_force(groups, {"P80": 0.8, "P90": 0.9})
    methods = ["exact", "approx"] if method == "both" else [method]
    assert result.keys() == {(s, m, level) for s, level in expected for m in methods}
    for (sku, _, level), row in result.items():
        assert row[:3] == expected[sku, level][:3]
        assert row[3] == pytest.approx(expected[sku, level][3], rel=1e-9, abs=1e-9)


def test_zero_deviation_rules(spark):
    groups = {
        "ONE_ROW": [(0, 1.0), (5, 7.0)], "NO_AMOUNT": [(5, None), (5, None)],
        "ONE_AMOUNT": [(5, None), (5, 3.0)],
    }
    result = stats(percentile_band_stats(base(spark, groups), "exact"))
    assert result["ONE_ROW", "exact", "P90"] == (5.0, 1, 1, 0.0)
    assert result["NO_AMOUNT", "exact", "P90"] == (5.0, 2, 0, 0.0)
    assert result["ONE_AMOUNT", "exact", "P90"] == (5.0, 2, 1, 0.0)


def test_histogram_equals_row_number_and_percentile_disc(spark):
    frame = base(spark, random_groups(5))
    group = Window.partitionBy(*KEYS)
    ranked = frame.withColumns({
        "n": F.count(F.lit(1)).over(group),
        "rank": F.row_number().over(group.orderBy(VALUE, "record_id")),
    }).where("rank = ceil(n * 0.9D)")
    by_rank = {r.sku: float(r.promotion_count) for r in ranked.collect()}
    built_in = frame.groupBy(*KEYS).agg(
        F.expr(f"percentile_disc(0.9) WITHIN GROUP (ORDER BY {VALUE})").alias("t")
    )
    by_built_in = {r.sku: r.t for r in built_in.collect()}
    exact = exact_percentiles(amount_histogram(frame), KEYS, VALUE).where("percentile_level = 'P90'")
    by_histogram = {r.sku: r.threshold for r in exact.collect()}
    assert by_histogram == by_rank == by_built_in


def test_approx_equals_exact_up_to_the_accuracy(spark):
    frame = spark.range(1, 60).select(F.explode(F.sequence(F.lit(1), F.col("id"))).alias("x"), "id")
    rows = frame.select(
        F.monotonically_increasing_id().alias("record_id"), F.col("id").cast("string").alias("sku"),
        F.lit("2022-04").alias("month"), (F.col("x") * 7 % 11).alias("promotion_count"),
        F.lit(1.0).alias("amount"),
    )
    deltas = compare_methods(rows)[0]
    assert deltas.count() == 118 and deltas.where("threshold_delta <> 0").isEmpty()


def test_accuracy_and_method_are_validated(spark):
    frame = base(spark, {"A": [(1, 1.0)]})
    with pytest.raises(ValueError, match="accuracy"):
        approx_percentiles(frame, KEYS, VALUE, 0)
    with pytest.raises(ValueError, match="method"):
        percentile_band_stats(frame, "median")


@pytest.mark.parametrize("unique", [True, False])
def test_base_counts_tokens_and_drops_missing_keys(spark, unique):
    rows = [
        (1, "2022-04-01", "A", "2022-04", 1.0, "P, Q,P"), (2, "2022-04-01", "A", "2022-04", None, None),
        (3, "2022-04-01", None, "2022-04", 1.0, "P"), (4, None, "A", None, 1.0, "P"),
    ]
    frame = spark.createDataFrame(
        rows, "record_id bigint, order_date string, sku string, month string, amount double, "
        "promotion_ids_raw string",
    )
    result = sku_month_base(frame, unique_records=unique).orderBy("record_id").collect()
    assert [(r.record_id, r.promotion_count) for r in result] == [(1, 2), (2, 0)]


def test_base_with_repeated_record_ids(spark):
    rows = [(1, "d", "A", "m", 1.0, "P,Q"), (1, "d", "A", "m", 2.0, "Q,R"), (1, "d", None, "m", 2.0, "S")]
    frame = spark.createDataFrame(
        rows, "record_id bigint, order_date string, sku string, month string, amount double, "
        "promotion_ids_raw string",
    )
    result = sku_month_base(frame, unique_records=False).collect()
    assert [(r.amount, r.promotion_count) for r in sorted(result, key=lambda r: r.amount)] == [
        (1.0, 4), (2.0, 4)
    ]


@pytest.mark.parametrize("staged", [True, False])
def test_differences_follow_from_the_thresholds(spark, staged):
    """Coarse sketches give other thresholds; all three frames must agree with brute force."""
    groups = random_groups(11)
    frame = base(spark, groups).repartition(6).cache()
    deltas, summary, differences = compare_methods(frame, accuracy=1, staged=staged)
    if not staged:
        assert deltas.count() == len(groups) * 2
        return
    thresholds = {(r.sku, r.percentile_level): r for r in deltas.collect()}
    assert any(r.threshold_delta for r in thresholds.values())
    exact = brute_force(groups, {"P80": 0.8, "P90": 0.9})
    expected_rows, expected_counts = set(), defaultdict(lambda: [0, 0])
    for row in frame.collect():
        for level in ("P80", "P90"):
            t = thresholds[row.sku, level]
            assert t.exact_threshold == exact[row.sku, level][0]
            assert t.threshold_delta == t.approx_threshold - t.exact_threshold
            left, right = (row.promotion_count >= x for x in (t.approx_threshold, t.exact_threshold))
            if left != right:
                side = "approx_only" if left else "exact_only"
                expected_rows.add((row.sku, level, row.record_id, side))
                expected_counts[row.sku, level][side == "exact_only"] += 1
    rows = {
        (r.sku, r.percentile_level, r.record_id, r.difference_side) for r in differences.collect()
    }
    assert rows == expected_rows
    counts = {
        (r.sku, r.percentile_level): [r.approx_only_count, r.exact_only_count]
        for r in summary.collect()
    }
    assert counts == {key: expected_counts[key] for key in thresholds}


def test_examples_are_bounded_and_ordered(spark):
    frame = base(spark, random_groups(11))
    examples = set_difference_examples(frame, n=5, accuracy=1).collect()
    order = [(r.sku, r.month, r.percentile_level, r.record_id) for r in examples]
    assert len(order) == 5 and order == sorted(order)


def test_final_result_is_ordered_with_four_rows_per_group(spark):
    rows = ordered_band_stats(base(spark, random_groups(3))).collect()
    keys = [(r.sku, r.month, r.method, r.percentile_level) for r in rows]
    assert keys == sorted(keys) and len(keys) == 24


def test_group_size_profile(spark):
    frame = base(spark, {"A": [(0, 1.0)] * 3, "B": [(0, 1.0)]})
    assert tuple(sku_month_profile(frame).first()) == (4, 2, 3, 0, 128, 384)
    assert tuple(group_size_profile(frame, KEYS, 2, 10).first()) == (4, 2, 3, 1, 10, 30)
    assert tuple(sku_month_profile(frame.where("1 = 0")).first()) == (0, 0, 0, 0, 128, 0)
    with pytest.raises(ValueError, match="bytes_per_row"):
        sku_month_profile(frame, bytes_per_row=0)


def test_group_size_on_rows(spark):
    frame = base(spark, {"A": [(0, 1.0)] * 3, "B": [(0, 1.0)]})
    sizes = {(r.sku, r.group_size) for r in with_group_size(frame, KEYS).collect()}
    assert sizes == {("A", 3), ("B", 1)}


def test_mean_and_sample_sd(spark):
    rows = [("approx", v) for v in (724, 704, 703, 692, 701)] + [("once", 5)]
    frame = spark.createDataFrame(rows, "method string, elapsed_ms bigint")
    result = {r.method: tuple(r)[1:] for r in mean_and_sample_sd(frame, "method", "elapsed_ms").collect()}
    assert result["once"] == (1, 5.0, 0.0)
    runs, mean, sd = result["approx"]
    assert (runs, mean) == (5, 704.8) and sd == pytest.approx(11.7346, abs=1e-4)
