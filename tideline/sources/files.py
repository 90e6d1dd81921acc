"""Small files and folders through the file systems that Spark itself uses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    """A file or folder: its name, and when it was last changed in milliseconds."""

    name: str
    changed: int
    folder: bool


def _on(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def listed(spark: SparkSession, path: str) -> list[Entry]:
    """What stands in a folder; nothing for a folder that is not there."""
    _, system, place = _on(spark, path)
    if not system.exists(place):
        return []
    found = system.listStatus(place)
    return [Entry(e.getPath().getName(), e.getModificationTime(), e.isDirectory()) for e in found]


def read_text(spark: SparkSession, path: str) -> str:
    jvm, system, place = _on(spark, path)
    stream = system.open(place)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file appear under its name with all its text; False if the name is taken.

    The text is written beside it and renamed. File systems with atomic renames (HDFS) refuse the
    second of two writers; elsewhere the caller has to make sure that there is one.
    """
    jvm, system, place = _on(spark, path)
    if system.exists(place):
        return False
    beside = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{jvm.java.util.UUID.randomUUID()}.tmp")
    stream = system.create(beside, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if system.exists(place) or not system.rename(beside, place):
        system.delete(beside, False)
        return False
    return True


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file, or a folder with all it holds; True if there was one."""
    _, system, place = _on(spark, path)
    return system.delete(place, True)
