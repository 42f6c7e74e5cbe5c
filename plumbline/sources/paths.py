"""Folders of any Hadoop file system: what publishing by rename needs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _opened(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _opened(spark, path)
    fs.delete(at, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, sorted; none if there is no folder."""
    at, fs = _opened(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder to a place that is free; a file system that cannot raises."""
    at, fs = _opened(spark, source)
    to, _ = _opened(spark, target)
    if fs.exists(to):
        raise FileExistsError(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"{source} could not be renamed to {target}")
