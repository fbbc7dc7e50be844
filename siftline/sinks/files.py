"""A few file-system calls through Hadoop, so that any cluster storage works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, from the root: what every machine understands alike."""
    target, fs = _path(spark, path)
    return fs.makeQualified(target).toString()


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match a glob, sorted."""
    target, fs = _path(spark, pattern)
    found = fs.globStatus(target) or []
    return sorted(status.getPath().toString() for status in found)
