"""Directory operations through Hadoop's FileSystem, so that any path Spark can
read works. They touch names and times only, never data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    modified_ms: int


def _open(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return handle.getFileSystem(conf), handle


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """Direct children of a directory; none if it does not exist. Any other
    failure propagates: it must not look like an absent directory."""
    fs, handle = _open(spark, path)
    if not fs.exists(handle):
        return []
    return [
        Entry(status.getPath().getName(), status.getModificationTime())
        for status in fs.listStatus(handle)
    ]


@dataclass(frozen=True)
class Match:
    path: str
    modified_ms: int


def matching_entries(spark: SparkSession, pattern: str) -> list[Match]:
    """What matches a glob, by one listing."""
    fs, handle = _open(spark, pattern)
    found = fs.globStatus(handle)
    if found is None:
        return []
    return [Match(s.getPath().toString(), s.getModificationTime()) for s in found]


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob."""
    return [found.path for found in matching_entries(spark, pattern)]


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _open(spark, path)
    return fs.exists(handle)


def create_empty(spark: SparkSession, path: str) -> None:
    """Create an empty file; an error if it is there already."""
    fs, handle = _open(spark, path)
    fs.create(handle, False).close()


def delete(spark: SparkSession, path: str) -> None:
    fs, handle = _open(spark, path)
    fs.delete(handle, True)
