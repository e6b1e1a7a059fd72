"""Folders of written tables: which are complete, and removing those that others replace."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names below a folder that start with ``prefix``, in order; none if there is no such folder."""
    files, where = _at(spark, path)
    if not files.exists(where):
        return []
    found = [status.getPath().getName() for status in files.listStatus(where)]
    return sorted(n for n in found if n.startswith(prefix))


def complete(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote a table came to its end."""
    files, where = _at(spark, path + "/_SUCCESS")
    return files.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    files, where = _at(spark, path)
    files.delete(where, True)
