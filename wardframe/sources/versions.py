"""Versioned outputs: complete folders behind one pointer.

An output folder holds ``_versions/<version>`` (the data) and ``_current/<version>`` (empty marks).  A version is
visible once its mark exists, and the mark is made only after all data are written and checked.  Making an empty
file is one atomic step on HDFS, on local disks and on object stores; nothing is renamed and nothing that a reader
may hold is overwritten.  A crash at any point leaves the last marked version current; what a crashed writer left
behind is removed by the next one.  Of two writers at once the one that began later wins, whichever ends first.

A folder without marks that holds files of its own is a plain table or model, and is its own current version.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import SparkSession

#: versions that stay after a publication, so readers of the one before can finish
KEEP = 2

_MARKS, _DATA = "_current", "_versions"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, location = file_system(spark, folder), _path(spark, folder)
    if not files.exists(location):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(location))


def _number(version: str) -> int:
    return int(version.split("-")[0])


def versions(spark: SparkSession, path: str) -> list[str]:
    """Published versions, oldest first."""
    return _names(spark, f"{path.rstrip('/')}/{_MARKS}")


def current(spark: SparkSession, path: str) -> str | None:
    """The folder (or file) to read for ``path``; None where nothing has been published."""
    root = path.rstrip("/")
    published = versions(spark, root)
    if published:
        return f"{root}/{_DATA}/{published[-1]}"
    files, location = file_system(spark, root), _path(spark, root)
    if not files.exists(location):
        return None
    if files.getFileStatus(location).isFile():
        return root
    return root if set(_names(spark, root)) - {_MARKS, _DATA} else None


def publish(spark: SparkSession, path: str, write: Callable[[str], object], keep: int = KEEP) -> str:
    """``write`` fills the folder of a new version, which is current from then on; its folder is returned.

    If ``write`` fails, nothing changes for readers.  A plain table at ``path`` is superseded and removed last.
    """
    root = path.rstrip("/")
    files = file_system(spark, root)
    taken = [*versions(spark, root), *_names(spark, f"{root}/{_DATA}")]
    version = f"{1 + max(map(_number, taken), default=0):012d}-{uuid4().hex}"
    folder = f"{root}/{_DATA}/{version}"
    if files.exists(_path(spark, root)) and files.getFileStatus(_path(spark, root)).isFile():
        raise FileExistsError(f"{path} is a single file")
    try:
        write(folder)
    except BaseException:
        files.delete(_path(spark, folder), True)
        raise
    if not files.createNewFile(_path(spark, f"{root}/{_MARKS}/{version}")):
        raise OSError(f"could not publish {path}")
    _expire(spark, root, keep)
    return folder


def _expire(spark: SparkSession, root: str, keep: int) -> None:
    """Remove all versions older than the last ``keep``, marks first, and what crashed writers left among them."""
    files = file_system(spark, root)
    published = versions(spark, root)
    kept = published[-keep:]
    for version in published[:-keep]:
        files.delete(_path(spark, f"{root}/{_MARKS}/{version}"), False)
    for version in _names(spark, f"{root}/{_DATA}"):
        if version not in kept and _number(version) < _number(kept[-1]):
            files.delete(_path(spark, f"{root}/{_DATA}/{version}"), True)
    for name in set(_names(spark, root)) - {_MARKS, _DATA}:
        files.delete(_path(spark, f"{root}/{name}"), True)
