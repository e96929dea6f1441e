"""Metric files: tab separated ``id, value, ts`` without a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRIC_ROW = "id string, value double, ts timestamp_ntz"


def _values_only(points: DataFrame) -> DataFrame:
    """NaN becomes NULL, since a gap must not reach an average."""
    return points.select("metric", "id", "ts", F.nanvl("value", F.lit(None).cast("double")).alias("value"))


def read_metric_files(spark: SparkSession, directory: str) -> DataFrame:
    """All ``*.tsv`` files below the directory; the metric is the file name up to its first dot, its escapes resolved."""
    rows = (
        spark.read.schema(METRIC_ROW)
        .option("sep", "\t")
        .option("pathGlobFilter", "*.tsv")
        .option("recursiveFileLookup", "true")
        .csv(directory)
    )
    # File names in the metadata are escaped as in a URL, where a plus sign stands for itself.
    name = F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))
    stem = F.substring_index(name, ".", 1)
    metric = F.coalesce(F.try_url_decode(F.replace(stem, F.lit("+"), F.lit("%2B"))), stem)
    return _values_only(rows.select("*", metric.alias("metric")))


def read_metric_table(spark: SparkSession, directory: str) -> DataFrame:
    """The same rows from the ``metric=…`` folders that ``append_metric_tsv`` writes; a test of the metric prunes folders."""
    rows = spark.read.schema(METRIC_ROW + ", metric string").option("sep", "\t").csv(directory)
    return _values_only(rows)
