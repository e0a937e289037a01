"""Folders and small text files on any store that Spark can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    """Hadoop's view of a path: the file system it lies on, and the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _open(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if there is no such folder."""
    fs, place = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def matching(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Paths below `root` that fit a pattern, relative to it and sorted."""
    fs, place = _open(spark, root)
    base = fs.makeQualified(place).toString().rstrip("/") + "/"
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{pattern}")) or []
    return sorted(fs.makeQualified(s.getPath()).toString().removeprefix(base) for s in found)


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _open(spark, path)
    fs.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _open(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Puts a whole file in place at once; False if there already is one of that name.

    The text is written aside and renamed, so no reader meets half of it.
    """
    fs, place = _open(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.exists(place) and fs.rename(aside, place):
        return True
    fs.delete(aside, False)
    return False
