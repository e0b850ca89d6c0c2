"""Results that several queries of one application share, stored once per state of the input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from tulha.session import scratch_path

_paths: dict[tuple, str] = {}


def _files(spark: SparkSession, folder: str) -> tuple:
    """Name, size and time of everything directly below a folder, and of the parts of tables."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for status in store.listStatus(path):
        inner = store.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in inner]
    return tuple(sorted(found))


def _is_there(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def shared_path(spark: SparkSession, label: str, folder: str, build: Callable[[str], None]) -> str:
    """The folder that ``build`` filled from the tables below ``folder``.

    It is built again when a table's files change, or when the result was deleted.
    """
    key = (spark.sparkContext.applicationId, label, folder, _files(spark, folder))
    path = _paths.get(key)
    if path is None or not _is_there(spark, path):
        path = scratch_path(spark, label)
        build(path)
        _paths[key] = path
    return path
