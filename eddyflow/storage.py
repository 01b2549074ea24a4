"""Folders of any store that Spark can write to, through Hadoop's file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _open(spark, path)
    return fs.exists(p)


def is_file(spark: SparkSession, path: str) -> bool:
    p, fs = _open(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def size_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """(files, bytes) under ``path``."""
    p, fs = _open(spark, path)
    found = fs.getContentSummary(p)
    return found.getFileCount(), found.getLength()


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` (none if it is missing)."""
    p, fs = _open(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def drop_folder(spark: SparkSession, path: str) -> None:
    p, fs = _open(spark, path)
    fs.delete(p, True)


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Remove ``path`` when the driver's JVM ends."""
    p, fs = _open(spark, path)
    fs.deleteOnExit(p)
