"""Small file operations through Hadoop's FileSystem, so they work wherever Spark reads."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class AlreadyThere(Exception):
    """The file that was to be created exists."""


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return bool(fs.exists(where))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; a folder that is not there has none. Any other error is raised."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, where = _at(spark, path)
    return int(fs.getContentSummary(where).getLength())


def create(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file; AlreadyThere if it exists (atomic where the store's create is)."""
    fs, where = _at(spark, path)
    fs.mkdirs(where.getParent())
    try:
        out = fs.create(where, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or "already exists" in str(error.java_exception.getMessage()):
            raise AlreadyThere(path) from None
        raise
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)
