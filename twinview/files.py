"""Folders and marker files, through the file system that Spark itself uses for a path."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _of(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, none if there is nothing."""
    path, files = _of(spark, pattern)
    return [s.getPath().toString() for s in files.globStatus(path) or []]


def exists(spark: SparkSession, path: str) -> bool:
    found, files = _of(spark, path)
    return files.exists(found)


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        found, files = _of(spark, path)
        files.delete(found, True)


def create(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if there is one already. Of several callers one succeeds, on file
    systems that create files exclusively (HDFS, local disks)."""
    found, files = _of(spark, path)
    if files.exists(found):
        return False
    try:
        files.create(found, False).close()
    except Exception as error:  # the other side's exception has no class here
        if "FileAlreadyExists" in str(error):
            return False
        raise
    return True


def make(spark: SparkSession, path: str) -> None:
    """Make an empty folder."""
    found, files = _of(spark, path)
    files.mkdirs(found)


def age_ms(spark: SparkSession, path: str, now_ms: int) -> int:
    found, files = _of(spark, path)
    return now_ms - files.getFileStatus(found).getModificationTime()
