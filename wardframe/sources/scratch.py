"""Written intermediate tables in the shared checkpoint folder.

A written table cuts lineage, survives executor loss and is computed once, so everything that is
derived from it (partition numbers, counts) agrees with itself.  The shuffle files of the job that wrote it go at once.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_folder: dict[str, str] = {}
_lock = threading.Lock()
_noted = threading.local()


def scratch_root(spark: SparkSession) -> str:
    """The folder named by the cluster; a temporary one only when Spark runs on this machine."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    with _lock:
        if application not in _local_folder:
            _local_folder[application] = tempfile.mkdtemp(prefix="wardframe-")
        return _local_folder[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/wardframe-{label}-{uuid.uuid4().hex}"
    for folders in getattr(_noted, "lists", []):
        folders.append(path)
    return path


@contextmanager
def noted() -> Iterator[list[str]]:
    """The folders that this thread's block names, for ``erased``."""
    _noted.lists = [*getattr(_noted, "lists", []), folders := []]
    try:
        yield folders
    finally:
        _noted.lists = _noted.lists[:-1]


@contextmanager
def _clean(spark: SparkSession) -> Iterator[None]:
    """What the block writes leaves no shuffle files: nothing reads them once the result is there."""
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, before)


def written(df: DataFrame, label: str = "table") -> tuple[DataFrame, str]:
    """Write once, read back; also the folder, for ``erased``."""
    path = scratch_path(df.sparkSession, label)
    with _clean(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialised(df: DataFrame, label: str = "table") -> DataFrame:
    """Write once, read back."""
    return written(df, label)[0]


def bucketed(df: DataFrame, label: str, column: str) -> DataFrame:
    """Write once in buckets of ``column``, as many as a shuffle has partitions: joins on it do not move the rows again."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    name = f"wardframe_{label}_{uuid.uuid4().hex}"
    with _clean(spark):
        df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def erased(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more, so that long jobs do not pile up disk."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
