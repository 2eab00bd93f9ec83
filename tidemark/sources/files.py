"""Small files and folders of the shared file system, by Hadoop's own interface: what Spark writes to, this reads."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder, if it is there."""
    system, place = _place(spark, path)
    system.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none where there is no folder."""
    system, place = _place(spark, path)
    return sorted(entry.getPath().getName() for entry in system.listStatus(place)) if system.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _place(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A file that is there as a whole or not at all: it is written under another name and moved."""
    system, place = _place(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    system.mkdirs(place.getParent())
    stream = system.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    system.delete(place, False)
    if not system.rename(beside, place):
        raise OSError(f"{path} could not be put into place")
