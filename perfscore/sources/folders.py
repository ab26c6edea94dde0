"""Folders of versions, listed by the file system that holds them.

A version is a subfolder ``name=value``; it counts once Spark has committed the write
(its ``_SUCCESS`` marker is there), so a half-written version is never chosen, and choosing
one reads no data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

MARKER = "_SUCCESS"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def values(spark: SparkSession, folder: str, name: str, committed: bool = True) -> list[str]:
    """The values of the subfolders ``name=value``, in order; only committed ones unless told otherwise."""
    fs, place = _file_system(spark, folder)
    if not fs.exists(place):
        return []
    out = []
    for entry in fs.listStatus(place):
        own = entry.getPath()
        if entry.isDirectory() and own.getName().startswith(f"{name}="):
            if not committed or fs.exists(spark._jvm.org.apache.hadoop.fs.Path(own, MARKER)):
                out.append(own.getName()[len(name) + 1:])
    return sorted(out)


def exists(spark: SparkSession, folder: str) -> bool:
    fs, place = _file_system(spark, folder)
    return fs.exists(place)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the library's own."""
    fs, place = _file_system(spark, folder)
    fs.delete(place, True)
