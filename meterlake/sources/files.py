"""The few file operations that tables need and DataFrames lack: names in a folder, removal, one small file at once.

They go through the Hadoop file system of the path, so they work on any storage Spark reads. Names and
journals come to the driver, never rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if the folder is not there."""
    fs, place = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path has the form of ``pattern``, in which * stands for any name."""
    fs, place = _open(spark, pattern)
    return bool(fs.globStatus(place))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all it holds; nothing happens if it is not there."""
    fs, place = _open(spark, path)
    fs.delete(place, True)


def publish(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it is there whole or not at all."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}.borrador"
    fs, place = _open(spark, draft)
    out = fs.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs.rename(place, target):  # an earlier attempt left it there
        fs.delete(target, False)
        fs.rename(place, target)


def read(spark: SparkSession, path: str) -> str:
    fs, place = _open(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
