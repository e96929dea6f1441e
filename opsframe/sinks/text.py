"""Text outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The time text of metric files.
TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def append_metric_tsv(points: DataFrame, path: str) -> None:
    """Appends ``id, value, ts`` to the folder of each metric, sorted by time.

    The range partitioning keeps few files per metric and still cuts a metric
    that holds most of the points.
    """
    rows = points.select("id", "value", F.date_format("ts", TIME_TEXT).alias("ts"), "metric")
    (
        rows.repartitionByRange("metric", "ts", "id")
        .sortWithinPartitions("metric", "ts", "id")
        .write.partitionBy("metric")
        .mode("append")
        .option("sep", "\t")
        .csv(path)
    )


def write_lines(df: DataFrame, path: str, column: str = "line") -> None:
    """One text line per row."""
    df.select(column).write.text(path)


def write_ragged(lines: DataFrame, path: str) -> None:
    """One line per instance, of differing length, below the folder of each metric."""
    lines.select("metric", "line").write.partitionBy("metric").text(path)


def write_name_pairs(pairs: DataFrame, path: str) -> None:
    """``project, stem, uuid`` divided by tabs."""
    pairs.select("project", "stem", "uuid").write.option("sep", "\t").option("quote", "").csv(path)


def write_mates(lines: DataFrame, path: str) -> None:
    """The lines of each mate, gzipped below ``mate=1`` and ``mate=2``.

    Both folders hold the reads in the same order when their parts are read by name.
    """
    ordered = lines.orderBy("mate", "file", "mate_ordinal").select("mate", "line")
    ordered.write.partitionBy("mate").option("compression", "gzip").text(path)


def write_ids(ids: DataFrame, path: str, column: str = "id") -> None:
    """Distinct ids, one per line."""
    ids.select(F.col(column).cast("string")).distinct().write.text(path)


def write_report(report: DataFrame, path: str) -> None:
    """``label: value`` lines of a report in one file, in order."""
    lines = report.orderBy("place").select(F.concat_ws(": ", "label", "value").alias("line"))
    lines.coalesce(1).write.text(path)


def run_name(cluster: str, run_id: str, utc_date: str) -> str:
    """Folder name of one run."""
    return f"{cluster}_{run_id}_{utc_date}"


def with_run(df: DataFrame, run_id: str, started: Column) -> DataFrame:
    """Adds ``run_id`` and the UTC date of the run, to partition an output table by."""
    return df.withColumn("run_id", F.lit(run_id)).withColumn("run_date", F.to_date(started))
