"""Folders and small marker files in any store that Spark reads, through Hadoop's file system."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def listed(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder and when each was last changed, in milliseconds; nothing if there is no folder."""
    files, place = _at(spark, path)
    return {s.getPath().getName(): s.getModificationTime() for s in files.listStatus(place)} if files.exists(place) else {}


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, with the folders above it."""
    files, place = _at(spark, path)
    files.create(place).close()


def move(spark: SparkSession, old: str, new: str) -> bool:
    """Rename a folder, atomically where the store can; False if it is gone already."""
    files, place = _at(spark, old)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    files.mkdirs(target.getParent())
    return files.exists(place) and files.rename(place, target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds; nothing happens if it is not there."""
    files, place = _at(spark, path)
    files.delete(place, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file; a reader may find none for the moment in which it is replaced."""
    files, place = _at(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    out = files.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(place, False)
    files.rename(new, place)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]
