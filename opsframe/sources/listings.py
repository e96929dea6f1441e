"""Listings of files and objects: names and sizes, never contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _below(path: Column, root: str) -> Column:
    """Text after ``root/``, which may follow a scheme; taken literally."""
    trimmed = root.rstrip("/") + "/"
    return F.substring(path, F.instr(path, F.lit(trimmed)) + len(trimmed), F.length(path))


def read_listing(spark: SparkSession, root: str, pattern: str | None = None, recursive: bool = True) -> DataFrame:
    """Key below the root, size and change time of each file; ``pattern`` selects by file name.

    Only the file index is read: without the ``content`` column no file is opened.
    Spark keeps that index on the driver; for a store with very many objects
    read its inventory table instead and use ``object_listing`` on it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select(
        _below(F.col("path"), root).alias("key"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def read_tree(spark: SparkSession, root: str) -> DataFrame:
    """Path of each file below the root, relative to the parent of the root."""
    name = root.rstrip("/").rsplit("/", 1)[-1]
    return read_listing(spark, root).select(F.concat(F.lit(name + "/"), F.col("key")).alias("path"), "size")
