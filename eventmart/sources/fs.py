"""File-system metadata calls (exists, delete, rename) on any Hadoop-supported store."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _open(spark, path)
    return system.exists(target)


def delete(spark: SparkSession, path: str) -> bool:
    system, target = _open(spark, path)
    return system.delete(target, True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Delete ``path`` when the driver's JVM ends, if it is still there."""
    system, target = _open(spark, path)
    system.mkdirs(target)
    system.deleteOnExit(target)


def make_dirs(spark: SparkSession, path: str) -> None:
    system, target = _open(spark, path)
    system.mkdirs(target)


def rename(spark: SparkSession, source: str, target: str) -> bool:
    system, origin = _open(spark, source)
    return system.rename(origin, spark._jvm.org.apache.hadoop.fs.Path(target))


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    system, target = _open(spark, path)
    system.setTimes(target, millis, -1)


def list_names(spark: SparkSession, path: str) -> list[str]:
    system, target = _open(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))
