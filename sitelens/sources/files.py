"""Folders of any file system that Spark writes to: look, move, remove."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark takes it to be on."""
    system, where = _at(spark, path)
    return system.makeQualified(where).toString()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a completed write is there: its success marker is."""
    system, where = _at(spark, f"{path}/_SUCCESS")
    return system.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it is not there."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(where) if s.isDirectory())


def bytes_below(spark: SparkSession, path: str) -> int:
    system, where = _at(spark, path)
    return system.getContentSummary(where).getLength()


def remove(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename ``path`` to ``to``; what was there goes first."""
    system, target = _at(spark, to)
    system.delete(target, True)
    if not system.rename(_at(spark, path)[1], target):
        raise OSError(f"cannot move {path} to {to}")
