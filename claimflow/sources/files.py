"""Small files and folder listings through Spark's own file systems, so that any path Spark reads works."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class AlreadyWritten(FileExistsError):
    """Another writer was first to write a file that is written once."""


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder in order; none if it does not exist."""
    fs, at = _file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def read_small(spark: SparkSession, path: str) -> str:
    fs, at = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole or not at all, and only if nobody has written it."""
    fs, at = _file_system(spark, path)
    _, temporary = _file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(temporary, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if fs.exists(at) or not fs.rename(temporary, at):
        fs.delete(temporary, False)
        raise AlreadyWritten(path)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)
