"""Small files and folders of the cluster's file systems, as the driver sees them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is no such folder."""
    fs, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _at(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> None:
    """A new file that others see whole or not at all: written beside its place and renamed."""
    fs, place = _at(spark, path)
    if fs.exists(place):
        raise FileExistsError(path)
    _, draft = _at(spark, f"{path}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.rename(draft, place):
        raise OSError(f"cannot be renamed: {path}.draft")


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)
