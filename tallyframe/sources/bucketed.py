"""Tables bucketed by a join key, so that repeated joins and groupings on it need no shuffle."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from .staging import new_path

_tables: list[str] = []


def bucketed_table(
    frame: DataFrame, keys: list[str], label: str, buckets: int | None = None
) -> DataFrame:
    """Write ``frame`` as a table in buckets of ``keys``, each bucket one sorted file; read it back.

    Rows are dealt to buckets first, so each bucket is written by one task as one file. Tables to
    be joined need the same number of buckets: by default the session's shuffle partitions, so
    that a bucket is read by one task of the usual size. One key lies in one bucket: for a key that
    dominates, an ordinary table joined by adaptive execution is the better choice. The files lie in
    the shared folder; :func:`drop_bucketed` removes the tables.
    """
    spark = frame.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{label.replace('-', '_')}_{uuid4().hex}"
    path = new_path(spark, label)
    frame.repartition(buckets, *keys).write.mode("error").format("parquet").option(
        "path", path
    ).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    _tables.append(name)
    return spark.table(name)


def drop_bucketed(spark: SparkSession) -> int:
    """Remove the tables this process has made, with their files; returns their number."""
    count = 0
    while _tables:
        name = _tables.pop()
        files = spark.table(name).inputFiles()
        spark.sql(f"DROP TABLE {name}")
        for file in files[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        count += 1
    return count
