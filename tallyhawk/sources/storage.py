"""What Hadoop's file systems say about paths, without a Spark job."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Content:
    present: bool
    n_files: int
    total_bytes: int


def _located(spark: SparkSession, path: str):
    """The path and its file system, as Java objects."""
    context = spark.sparkContext
    located = context._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(context._jsc.hadoopConfiguration())


def content(spark: SparkSession, path: str) -> Content:
    """Files and bytes at a path, from the file system's own summary."""
    located, system = _located(spark, path)
    if not system.exists(located):
        return Content(False, 0, 0)
    summary = system.getContentSummary(located)
    return Content(summary.getFileCount() > 0, summary.getFileCount(), summary.getLength())


def child_folders(spark: SparkSession, path: str) -> list[str]:
    located, system = _located(spark, path)
    if not system.exists(located):
        return []
    return [status.getPath().getName() for status in system.listStatus(located) if status.isDirectory()]


def delete(spark: SparkSession, path: str) -> None:
    """Remove a path and all below it, if it is there."""
    located, system = _located(spark, path)
    system.delete(located, True)


@dataclass(frozen=True)
class File:
    path: str
    n_bytes: int
    modified: int


def files_below(spark: SparkSession, path: str) -> list[File]:
    """Every data file at or below a path, by path; names that readers skip are left out."""
    located, system = _located(spark, path)
    if not system.exists(located):
        return []
    found, entries = [], system.listFiles(located, True)
    while entries.hasNext():
        status = entries.next()
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            found.append(File(status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found, key=lambda f: f.path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file as text; None if it is not there."""
    located, system = _located(spark, path)
    if not system.exists(located):
        return None
    stream = system.open(located)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete before it has its name."""
    located, system = _located(spark, path)
    unfinished = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = system.create(unfinished, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    system.delete(located, False)
    system.rename(unfinished, located)


def move(spark: SparkSession, old: str, new: str) -> None:
    """Give a path another name in the same file system."""
    located, system = _located(spark, old)
    if not system.rename(located, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"{old} could not become {new}")
