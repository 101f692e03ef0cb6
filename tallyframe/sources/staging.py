"""Tables written once in the cluster's shared folder and read back.

Staging a small aggregate does three things at once: the large scan below it runs a
single time even if later steps use the aggregate twice, a lost executor costs no
recomputation of that scan, and the file sizes tell Catalyst whether the table is small
enough for a broadcast join.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_staged: list[str] = []
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    """Folder named by the session, or by its context's checkpoint directory.

    Only a session whose executors are threads of the driver may do without; it stages in its
    warehouse folder.
    """
    folder = spark.conf.get(SHARED_FOLDER_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(f"{SHARED_FOLDER_SETTING} must name a folder that all executors share")
    return f"{spark.conf.get(WAREHOUSE_SETTING).rstrip('/')}/staged"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/tallyframe/{label}-{uuid4().hex}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of a query when it ends, not when the driver next collects."""
    before = spark.conf.get(CLEANUP_SETTING, None)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_SETTING)
        else:
            spark.conf.set(CLEANUP_SETTING, before)


def stage(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` as a new table in the shared folder and return the table.

    The shuffle files of the write go with its end: nothing else reads them, and of many staged
    steps they would otherwise fill the disks together.
    """
    spark = frame.sparkSession
    path = new_path(spark, label)
    _staged.append(path)
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    with _shuffles_removed(spark):
        frame.write.mode("error").option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def settled(build: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``build`` returns as a staged table, without the tables that were staged on the way.

    Nothing else may read those. Calls can be nested, and other threads are not concerned.
    """
    own: list[str] = []
    token = _scope.set(own)
    try:
        frame = build()
    finally:
        _scope.reset(token)
    result = stage(frame, label)
    for path in own:
        _staged.remove(path)
        _remove(result.sparkSession, path)
    return result


def _remove(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(spark: SparkSession) -> int:
    """Remove the tables this process has staged; frames built on them can't be read any more."""
    count = 0
    while _staged:
        count += bool(_remove(spark, _staged.pop()))
    return count
