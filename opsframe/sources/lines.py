"""Text files as numbered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opsframe.storage import cut_lineage


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Columns ``file``, ``ordinal`` (from 0), ``n_lines`` and ``line``.

    A file is read in blocks by several tasks, so each block counts its own
    lines and one row per block tells how many lines stand before it: one huge
    file needs no task of its own.  The lines are written once, since both the
    counts and the numbers within a block must come from the same reading.
    """
    raw = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("line"),
    )
    raw = cut_lineage(raw, "lines")
    of_file = Window.partitionBy("file")
    earlier = of_file.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = raw.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    starts = blocks.select(
        "file", "_block", "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(of_file).alias("n_lines"),
    )
    return raw.join(starts, ["file", "_block"]).select(
        "file", (F.col("_before") + F.col("_id") - F.col("_first")).alias("ordinal"), "n_lines", "line"
    )


def in_sequence(lines: DataFrame) -> DataFrame:
    """Adds ``place``: the number of each line when the files follow each other by name.

    One row per file is all that meets in a task.  Columns of ``lines`` stay.
    """
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = lines.groupBy("file").agg(F.max("n_lines").alias("_n"))
    before = files.select("file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return lines.join(before, "file").select(*lines.columns, (F.col("_before") + F.col("ordinal")).alias("place"))
