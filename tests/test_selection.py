"""Ranks by radix refinement, running counts in blocks, and quantile sketches."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallyframe.operators.moments import ROWS
from tallyframe.operators.percentiles import exact_band_stats, exact_percentiles, value_histogram
from tallyframe.operators.running import (
    band_stats_by_blocks,
    percentiles_by_blocks,
    running_sums_by_blocks,
)
from tallyframe.operators.selection import (
    median_by_selection,
    nearest_rank,
    percentiles_by_selection,
    values_at_ranks,
)
from tallyframe.operators.sketches import (
    RANK_ERROR,
    merged_sketches,
    rank_errors,
    sketch_percentiles,
    sketch_table,
)
from tallyframe.operators.variety import exact_median

LEVELS = {"P01": 0.01, "P50": 0.5, "P80": 0.8, "P100": 1.0}
LONG = 2**63 - 1


def groups(seed):
    chance = random.Random(seed)
    return {
        "ends": [-LONG - 1, LONG], "one": [7], "same": [5] * 40, "two": [-3, 4], None: [1, 2, 2, 9],
        "wide": [chance.randint(-LONG - 1, LONG) for _ in range(301)],
        "steps": [chance.choice((-1, 1)) * 2 ** chance.randint(0, 62) for _ in range(200)],
        "narrow": [chance.randint(0, 26) for _ in range(500)], "near": [10**15 + k for k in range(5001)],
        "no values": [None, None], "some": [None, 4, None, 6],
    }


def frame(spark, values):
    rows = [(key, v) for key, some in values.items() for v in some]
    return spark.createDataFrame(rows, "k string, v bigint").repartition(5)


@pytest.mark.parametrize("salt_values", [100_000, 37])
def test_ranks_against_sorting(spark, salt_values):
    values = groups(1)
    ranks = {name: nearest_rank(p) for name, p in LEVELS.items()}
    found = values_at_ranks(frame(spark, values), ["k"], "v", ranks, salt_values=salt_values)
    expected = {
        (key, name): (sorted(own)[math.ceil(p * len(own)) - 1], len(own))
        for key, some in values.items() if (own := [v for v in some if v is not None])
        for name, p in LEVELS.items()
    }
    assert {(r.k, r.rank_name): (r.v, r.group_rows) for r in found.collect()} == expected


def test_median_equals_the_aggregate(spark):
    rows = frame(spark, groups(2))
    expected = sorted(exact_median(rows, ["k"], "v").collect(), key=str)
    assert sorted(median_by_selection(rows, ["k"], "v").collect(), key=str) == expected
    two_keys = rows.withColumn("half", F.when(F.col("v") % 2 == 0, "even"))
    assert sorted(median_by_selection(two_keys, ["k", "half"], "v", salt_values=3).collect(), key=str) == sorted(
        exact_median(two_keys, ["k", "half"], "v").collect(), key=str
    )


def test_amounts_with_decimals(spark):
    chance = random.Random(4)
    amounts = [round(chance.uniform(-1e6, 1e6), 2) for _ in range(1000)]
    rows = spark.createDataFrame([("a", x) for x in amounts], "k string, v double")
    assert median_by_selection(rows, ["k"], "v", scale=2).first()["median"] == statistics.median(amounts)
    odd = spark.createDataFrame([("a", 0.125)], "k string, v double")
    with pytest.raises(Exception, match="no whole number"):
        median_by_selection(odd, ["k"], "v", scale=2).collect()


def test_no_rows(spark):
    none = spark.createDataFrame([], "k string, v bigint")
    assert median_by_selection(none, ["k"], "v").count() == 0
    assert percentiles_by_selection(none, ["k"], "v", LEVELS).count() == 0


def test_one_large_group_of_distinct_values(spark):
    rows = spark.range(200_000).select(F.lit("a").alias("k"), (F.col("id") * 7919 % 200_003).alias("v"))
    found = median_by_selection(rows, ["k"], "v", salt_values=10_000).first()
    values = sorted(i * 7919 % 200_003 for i in range(200_000))
    assert found["median"] == (values[99_999] + values[100_000]) / 2 and found["group_size"] == 200_000


@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_equal_the_window(spark, seed):
    chance = random.Random(seed)
    rows = [
        (key, chance.randint(0, spread), chance.choice([None, round(chance.uniform(0, 99), 2)]))
        for key, size, spread in (("hot", 3000, 2000), ("b", 1, 5), ("c", 9, 3), (None, 60, 60))
        for _ in range(size)
    ]
    base = spark.createDataFrame(rows, "k string, v bigint, amount double")
    histogram = value_histogram(base, ["k"], "v", "amount")
    expected = sorted(exact_percentiles(histogram, ["k"], "v").collect(), key=str)
    assert sorted(percentiles_by_blocks(histogram, ["k"], "v").collect(), key=str) == expected
    whole = sorted(exact_band_stats(histogram, ["k"], "v").collect(), key=str)
    assert sorted(band_stats_by_blocks(histogram, ["k"], "v").collect(), key=str) == whole
    empty = histogram.where("false")
    assert band_stats_by_blocks(empty, ["k"], "v").count() == 0


def test_running_sums_carry_over_blocks(spark):
    chance = random.Random(8)
    places = {key: sorted(chance.sample(range(-5000, 5000), n)) for key, n in (("a", 300), ("b", 1), (None, 40))}
    rows = [(key, p, chance.randint(-9, 9), 1) for key, own in places.items() for p in own]
    changes = spark.createDataFrame(rows, "k string, at bigint, x bigint, n bigint")
    expected = []
    for key, own in places.items():
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        total = 0
        for i, (_, at, x, _) in enumerate(mine):
            total += x
            expected.append((key, at, mine[i + 1][1] if i + 1 < len(mine) else None, total, i + 1))
    for block in (1, 64, 10**6):
        found = running_sums_by_blocks(changes, ["k"], "at", ["x", "n"], block)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_sketches_merge_and_keep_their_bound(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 3).alias("k"), (F.col("id") % 50).alias("day"),
        F.pmod(F.xxhash64("id"), F.lit(1_000_000)).alias("v"),
    )
    daily = sketch_table(rows, ["k", "day"], "v")
    assert daily.count() == 150
    merged = merged_sketches(daily, ["k"])
    assert {(r.k, r.sketch_rows) for r in merged.collect()} == {(0, 20_000), (1, 20_000), (2, 20_000)}
    errors = rank_errors(rows, sketch_percentiles(merged, ["k"]), ["k"], "v").collect()
    assert len(errors) == 6 and all(0 <= r.rank_error <= 2 * RANK_ERROR for r in errors)
    assert all(r.group_rows == 20_000 for r in errors)


def test_small_sketches_are_exact(spark):
    values = {key: some for key, some in groups(5).items() if key in ("one", "same", "two", "some", "ends")}
    rows = frame(spark, values).withColumn("slice", F.coalesce(F.col("v") % 3, F.lit(0)))
    sketches = merged_sketches(sketch_table(rows, ["k", "slice"], "v"), ["k"])
    found = {(r.k, r.percentile_level): r.threshold for r in sketch_percentiles(sketches, ["k"], LEVELS).collect()}
    for key, some in values.items():
        own = sorted(v for v in some if v is not None)
        for name, p in LEVELS.items():
            assert found[key, name] == float(own[math.ceil(p * len(own)) - 1])
    assert sketch_table(rows.where("false"), ["k"], "v").count() == 0
    assert ROWS not in sketches.columns
