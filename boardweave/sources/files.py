"""Small file-system helpers that work on any file system Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.delete(target, True)


def touch(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.create(target, True).close()
