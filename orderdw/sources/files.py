"""Small files and listings in whatever store a path names, by the session's own file systems."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system of ``path``, and the path as that system's own object."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def listed(spark: SparkSession, path: str) -> dict[str, tuple[str, bool]]:
    """What lies in ``path``: name, whole path, whether it is a folder. Nothing for no path."""
    system, at = file_system(spark, path)
    try:
        found = system.listStatus(at)
    except Py4JJavaError as failed:
        if "FileNotFound" in failed.java_exception.getClass().getName():
            return {}
        raise
    return {f.getPath().getName(): (f.getPath().toString(), f.isDirectory()) for f in found}


def folders(spark: SparkSession, path: str, column: str | None = None) -> dict[str, str]:
    """The folders in ``path`` by name, or by value for those named ``column=value``."""
    prefix = f"{column}=" if column else ""
    return {n[len(prefix):]: p for n, (p, is_folder) in listed(spark, path).items()
            if is_folder and n.startswith(prefix)}


def read_text(spark: SparkSession, path: str) -> str:
    system, at = file_system(spark, path)
    stream = system.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file; False, and nothing written, if there is one already."""
    system, at = file_system(spark, path)
    try:
        stream = system.create(at, False)
    except Py4JJavaError as failed:
        if "AlreadyExists" in failed.java_exception.getClass().getName():
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def remove(spark: SparkSession, path: str) -> None:
    system, at = file_system(spark, path)
    system.delete(at, True)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    system, at = file_system(spark, path)
    return system.getContentSummary(at).getLength()
