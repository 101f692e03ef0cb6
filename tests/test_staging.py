"""Where intermediate tables go, and how they are removed."""

import time

import pytest
from pyspark.sql import functions as F

from tallyframe.operators.percentiles import with_group_size
from tallyframe.sources import staging


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder


class Session:
    def __init__(self, master, folder=None, **conf):
        self.sparkContext, self.conf = Context(master, folder), Conf(conf)


def test_shared_folder():
    setting = {staging.SHARED_FOLDER_SETTING: "hdfs://shared/"}
    assert staging.shared_folder(Session("yarn", **setting)) == "hdfs://shared"
    assert staging.shared_folder(Session("spark://a", "hdfs://set")) == "hdfs://set"
    warehouse = {staging.WAREHOUSE_SETTING: "file:/w/"}
    assert staging.shared_folder(Session("local[4]", **warehouse)) == "file:/w/staged"
    for master in ("yarn", "local-cluster[2,1,1024]", "k8s://a"):
        with pytest.raises(ValueError, match="checkpoint"):
            staging.shared_folder(Session(master, **warehouse))


def test_drop_staged(spark):
    staging.drop_staged(spark)
    table = staging.stage(spark.range(5), "numbers")
    assert table.count() == 5
    assert staging.drop_staged(spark) == 1 and staging.drop_staged(spark) == 0
    with pytest.raises(Exception, match="(?i)exist|not found"):
        spark.read.parquet(table.inputFiles()[0]).count()


def test_settled_removes_what_was_staged_on_the_way(spark):
    staging.drop_staged(spark)
    before = staging.stage(spark.range(3), "before")
    inner = []

    def build():
        inner.append(staging.stage(spark.range(7), "inner"))
        inner.append(staging.settled(lambda: staging.stage(inner[0].where("id > 1"), "deep"), "nested"))
        return inner[1].join(before, "id", "left_semi")

    result = staging.settled(build, "result")
    assert [row["id"] for row in result.collect()] == [2] and before.count() == 3
    for table in inner:
        with pytest.raises(Exception, match="(?i)exist|not found"):
            spark.read.parquet(table.inputFiles()[0]).count()
    assert staging.drop_staged(spark) == 2


def test_group_size_keeps_null_keys(spark):
    frame = spark.createDataFrame([("a", None), ("a", None), ("b", "m")], "k string, n string")
    rows = with_group_size(frame, ["k", "n"])
    assert rows.columns == ["k", "n", "group_size"]
    assert sorted(map(str, map(tuple, rows.collect()))) == [
        "('a', None, 2)", "('a', None, 2)", "('b', 'm', 1)"
    ]


def test_shuffle_files_of_a_staged_table_go_when_it_is_written(spark):
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = spark.conf.get(staging.CLEANUP_SETTING)
    held = tracker.shuffleStatuses().size()
    for k in range(3):
        staged = staging.stage(spark.range(1000).groupBy(F.col("id") % 7).count(), "few-rows")
        assert staged.count() == 7
        frame = staged.repartition(3, "count")
        assert staging.stage(frame, "few-rows").count() == 7
    assert spark.conf.get(staging.CLEANUP_SETTING) == before
    deadline = time.monotonic() + 20
    while tracker.shuffleStatuses().size() >= held + 6 and time.monotonic() < deadline:
        time.sleep(0.1)
    assert tracker.shuffleStatuses().size() < held + 6
