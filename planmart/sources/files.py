"""Small files and folders on whatever storage a path names (Hadoop file systems)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, where, fs = _at(spark, path)
    return fs.exists(where)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below `path`; none if it doesn't exist."""
    _, where, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()) if fs.exists(where) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written under another name first, so that readers see all of it or none."""
    jvm, where, fs = _at(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(part, where):
        raise OSError(f"{path} is there already")


def read_text(spark: SparkSession, path: str) -> str:
    _, where, fs = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    _, where, fs = _at(spark, path)
    fs.delete(where, True)
