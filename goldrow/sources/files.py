"""Hadoop file-system listing, used for directory metadata only."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(_path(spark, path))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below a directory in listing order; empty if it is none."""
    fs, p = file_system(spark, path), _path(spark, path)
    if not fs.exists(p) or not fs.getFileStatus(p).isDirectory():
        return []
    return [status.getPath().getName() for status in fs.listStatus(p)]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file of metadata, over an older one."""
    out = file_system(spark, path).create(_path(spark, path), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file of metadata; None if it is not there."""
    fs, p = file_system(spark, path), _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def modified(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names below a directory and when they were last changed, in milliseconds."""
    fs, p = file_system(spark, path), _path(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p)]


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in a place that must be free; False if it is taken.

    The file is written elsewhere and renamed, so it is whole as soon as it is there.
    """
    jvm = spark._jvm
    folder, name = path.rsplit("/", 1)
    written = f"{folder}/.{name}-{uuid.uuid4().hex}"
    write_text(spark, written, text)
    target = _path(spark, path)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    uri = file_system(spark, path).makeQualified(target).toUri()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        uri, spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(_path(spark, written), target, options)
    except Py4JJavaError as error:
        drop_file(spark, written)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def drop_file(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).delete(_path(spark, path), False)


def drop_directory(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).delete(_path(spark, path), True)
