"""Folder questions asked through Spark's own file system layer."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def list_glob(spark: SparkSession, pattern: str) -> list[str]:
    hadoop_path, fs = _path(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(hadoop_path) or []]


def remove(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _path(spark, path)
    fs.delete(hadoop_path, True)
