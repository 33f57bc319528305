"""Small file operations on whatever file system a path belongs to (local, HDFS, object store), through Hadoop."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none if there is no such folder."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new small file; an existing one makes it fail (two writers cannot both win)."""
    fs, p = _fs(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename(spark: SparkSession, src: str, dest: str) -> None:
    fs, p = _fs(spark, src)
    if not fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dest)):
        raise OSError(f"could not rename {src} to {dest}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
