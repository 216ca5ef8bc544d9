"""Small files and folders on whatever file system Spark reads: local, HDFS or an object store."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    system, where = _at(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(where)) if system.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    system, where = _at(spark, path)
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file that is there as a whole or not at all: written beside its place, then renamed."""
    system, where = _at(spark, path)
    _, beside = _at(spark, f"{path}.part")
    out = system.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not system.rename(beside, where):
        raise OSError(f"could not rename {beside} to {where}")


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a file or a folder with all it holds, if it is there."""
    system, where = _at(spark, folder)
    system.delete(where, True)
