"""Folders and small files of the shared storage, through Spark's own file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(hadoop_path(spark, path))


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names below ``folder``, sorted; none if there is no such folder."""
    if not exists(spark, folder):
        return []
    found = file_system(spark, folder).listStatus(hadoop_path(spark, folder))
    return sorted(status.getPath().getName() for status in found)


def size_of(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below ``folder``."""
    return file_system(spark, folder).getContentSummary(hadoop_path(spark, folder)).getLength()


def make_folder(spark: SparkSession, folder: str) -> None:
    file_system(spark, folder).mkdirs(hadoop_path(spark, folder))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename; raises where the file system reports failure by false."""
    if not file_system(spark, target).rename(hadoop_path(spark, source), hadoop_path(spark, target)):
        raise OSError(f"could not move {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(hadoop_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    stream = file_system(spark, path).open(hadoop_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def add_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path`` whole or not at all; false if it is there already.

    Readers never see a part of it: it is written under another name and renamed, by a rename
    that does not replace.
    """
    fs = spark._jvm.org.apache.hadoop.fs
    folder, name = path.rsplit("/", 1)
    hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
    stream = file_system(spark, folder).create(hadoop_path(spark, hidden), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = fs.FileContext.getFileContext(
        file_system(spark, folder).getUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(hadoop_path(spark, hidden), hadoop_path(spark, path), options)
    except Exception:
        delete(spark, hidden)
        if exists(spark, path):
            return False
        raise
    return True
