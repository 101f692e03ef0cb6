"""Tables in buckets of their join key."""

from pyspark.sql import functions as F

from tallyframe.operators.keys import left_counts, lookup_join
from tallyframe.sources.bucketed import bucketed_table, drop_bucketed


def plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_joins_and_counts_need_no_exchange(spark):
    orders = spark.range(500).select(F.col("id").alias("record_id"), (F.col("id") % 7).alias("v"))
    tokens = spark.range(900).select((F.col("id") % 300).alias("record_id"), F.col("id").alias("t"))
    left = bucketed_table(orders, ["record_id"], "left-rows")
    right = bucketed_table(tokens, ["record_id"], "right-rows")
    counts = right.groupBy("record_id").count()
    joined = left_counts(left, counts.hint("merge"), ["record_id"], ["count"])
    assert "Exchange" not in plan(joined)
    assert {(r.record_id, r["count"]) for r in joined.collect()} == {
        (i, 3 if i < 300 else 0) for i in range(500)
    }
    hashed = lookup_join(left, right, ["record_id"], "inner", "shuffle_hash")
    assert "Exchange" not in plan(hashed) and hashed.count() == 900
    files = left.inputFiles()
    assert len(files) <= 8
    assert drop_bucketed(spark) == 2 and drop_bucketed(spark) == 0


def test_null_keys_and_no_rows(spark):
    rows = spark.createDataFrame([(None, "a"), (1, "b"), (1, "c"), (None, "d")], "k int, v string")
    table = bucketed_table(rows, ["k"], "null-keys", buckets=3)
    assert sorted(map(tuple, table.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    assert bucketed_table(rows.where("false"), ["k"], "no-rows").count() == 0
    drop_bucketed(spark)
