"""Small folder operations through Hadoop's file system API (local disk, HDFS, object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Written by this package as the last step of a folder.  Spark's own _SUCCESS is not relied on:
# clusters and committers may not write it.
DONE = "_COMPLETE"


def open_path(spark: SparkSession, path: str):
    """The file system a path lives on, and the path as that file system takes it."""
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = open_path(spark, path)
    return fs.exists(handle)


def size_of(spark: SparkSession, path: str) -> int:
    fs, handle = open_path(spark, path)
    return fs.getContentSummary(handle).getLength()


def finished_children(spark: SparkSession, path: str, marker: str = DONE) -> list[str]:
    """Names of the direct subfolders whose ``marker`` file exists, sorted by name."""
    fs, handle = open_path(spark, f"{path}/*/{marker}")
    found = fs.globStatus(handle) or []
    return sorted(status.getPath().getParent().getName() for status in found)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, handle = open_path(spark, path)
    stream = fs.create(handle, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_lines(spark: SparkSession, path: str) -> list[str]:
    """Lines of a small control file."""
    fs, handle = open_path(spark, path)
    stream = fs.open(handle)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return [line for line in text.split("\n") if line]


def mark_done(spark: SparkSession, folder: str, text: str = "") -> None:
    """Make a folder count as complete; ``text`` may say more about it."""
    write_text(spark, f"{folder}/{DONE}", text)


def is_done(spark: SparkSession, folder: str) -> bool:
    return exists(spark, f"{folder}/{DONE}")


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder unless the target is there; returns whether it was done."""
    fs, old = open_path(spark, source)
    new = open_path(spark, target)[1]
    return not fs.exists(new) and fs.rename(old, new)


def remove(spark: SparkSession, path: str) -> bool:
    fs, handle = open_path(spark, path)
    return fs.delete(handle, True)
