"""Small files in any of Hadoop's file systems, by the same URIs that Spark reads and writes."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    """A file or folder in a folder."""

    name: str
    size: int
    is_folder: bool


def _path(spark: SparkSession, path: str):
    """Hadoop's path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _is(error: Py4JJavaError, name: str) -> bool:
    return error.java_exception.getClass().getName().endswith(name)


def qualified(spark: SparkSession, path: str) -> str:
    """The whole URI of a path, as Spark tells it for the files it reads."""
    at, files = _path(spark, path)
    return files.makeQualified(at).toUri().toString()


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _path(spark, path)
    return files.exists(at)


def entries(spark: SparkSession, folder: str) -> list[Entry]:
    """What a folder holds, by name; nothing if there is no such folder."""
    at, files = _path(spark, folder)
    try:
        found = files.listStatus(at)
    except Py4JJavaError as error:
        if _is(error, "FileNotFoundException"):
            return []
        raise
    return sorted((Entry(f.getPath().getName(), f.getLen(), f.isDirectory()) for f in found), key=lambda e: e.name)


def read_text(spark: SparkSession, path: str) -> str:
    at, files = _path(spark, path)
    stream = files.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file; False, and nothing is changed, if there is one.

    The text is complete before the file gets its name, by a rename that replaces nothing. Of
    several callers at once one gets True where the store renames atomically, as HDFS does.
    """
    at, files = _path(spark, path)
    draft, _ = _path(spark, f"{at.getParent()}/.{at.getName()}-{uuid.uuid4().hex}")
    files.mkdirs(at.getParent())
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(files.makeQualified(at).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    replace_nothing = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(at), replace_nothing)
    except Py4JJavaError as error:
        files.delete(draft, False)
        if _is(error, "FileAlreadyExistsException"):
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all in it, if it is there."""
    at, files = _path(spark, path)
    files.delete(at, True)
