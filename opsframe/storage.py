"""Shared storage that survives the loss of an executor."""

from __future__ import annotations

import contextlib
import functools
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as named by ``spark.checkpoint.dir``.

    Only a session in one process without that setting gets a temporary folder:
    on a cluster, one on a single machine included, executors do not share it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="opsframe-")


def scratch_dir(spark: SparkSession) -> str:
    """The folder below the shared one that holds what this application wrote."""
    return f"{shared_dir(spark)}/opsframe/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the scratch folder that nothing has used before."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Removes all intermediate tables of this application; results that still read them are lost."""
    remove_folder(spark, scratch_dir(spark))


def _hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder and all below it."""
    found, store = _hadoop_path(spark, path)
    store.delete(found, True)


def committed_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path`` that a Spark job has finished writing."""
    found, store = _hadoop_path(spark, path)
    if not store.exists(found):
        return []
    mark = spark._jvm.org.apache.hadoop.fs.Path
    folders = [entry.getPath() for entry in store.listStatus(found) if entry.isDirectory()]
    return [folder.getName() for folder in folders if store.exists(mark(folder, "_SUCCESS"))]


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Later steps then see the same rows however often they are evaluated or
    retried, and read only the columns they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows, or as many as the session allows, in the jobs run meanwhile."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows if int(before) <= 0 else min(rows, int(before)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path for use within tasks, and the path in it; names of Spark's S3 schemes are understood."""
    try:
        return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError) as error:
        raise ValueError(f"not an absolute path, nor in a store that pyarrow reads: {uri}") from error
