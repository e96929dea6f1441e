"""Listings of large trees: folders are expanded by tasks, level by level."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.storage import cut_lineage, open_store

_ENTRY = pa.schema([("key", pa.string()), ("size", pa.int64()), ("modified", pa.timestamp("us", tz="UTC")), ("is_folder", pa.bool_())])
#: Entries that a task hands on at once.
ENTRIES = 10_000


def _expand(root: str, pattern: str | None):
    def run(batches) -> Iterator[pa.RecordBatch]:
        store, base = open_store(root)
        base = base.rstrip("/")
        for batch in batches:
            for prefix in batch.column("prefix").to_pylist():
                found = store.get_file_info(pafs.FileSelector(f"{base}/{prefix}", recursive=False))
                rows = []
                for entry in found:
                    folder = entry.type == pafs.FileType.Directory
                    if entry.base_name.startswith(("_", ".")) or not folder and pattern and not fnmatch.fnmatchcase(entry.base_name, pattern):
                        continue
                    rows.append((f"{prefix}{entry.base_name}{'/' if folder else ''}", entry.size, entry.mtime, folder))
                for at in range(0, len(rows), ENTRIES):
                    columns = zip(*rows[at : at + ENTRIES])
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _ENTRY)], schema=_ENTRY)

    return run


def walk_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """``key, size, modified`` of each file below ``root``; ``pattern`` selects by file name.

    Each round expands the folders that the round before found, one folder by one task, and writes what they hold: the
    driver sees how deep the tree is, never an index of its files.  The entries of a single folder have to fit
    a task.  Names that begin with ``_`` or ``.`` are hidden, as they are to Spark's readers.
    """
    level, levels = spark.createDataFrame([("",)], "prefix string"), []
    while not level.isEmpty():
        dealt = level.repartition("prefix")
        listed = cut_lineage(dealt.mapInArrow(_expand(root, pattern), "key string, size bigint, modified timestamp, is_folder boolean"), "listing")
        levels.append(listed.filter("not is_folder").drop("is_folder"))
        level = listed.filter("is_folder").select(F.col("key").alias("prefix"))
    return reduce(DataFrame.unionByName, levels)


def folder_totals(files: DataFrame) -> DataFrame:
    """``folder, n_files, bytes``: the files that lie in each folder itself, the root being the empty name."""
    folder = F.regexp_replace("key", "/?[^/]*$", "")
    return files.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("bytes"))
