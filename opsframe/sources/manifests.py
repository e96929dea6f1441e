"""Manifest files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.operators.manifest import BLANKS, manifest_rows

NAME_PAIR_ROW = "project string, stem string, uuid string"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Run, project and layout; comment and blank lines dropped."""
    return manifest_rows(spark.read.text(path), "value")


def read_gdc_manifest(spark: SparkSession, path: str) -> DataFrame:
    """First field of each line after the header; blank lines dropped."""
    rows = spark.read.option("header", "true").option("sep", "\t").option("quote", "").csv(path)
    first = F.btrim(F.col(f"`{rows.columns[0]}`"), F.lit(BLANKS))
    return rows.select(first.alias("id")).filter(F.col("id") != "")


def read_name_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Project, stem and id of renamed files."""
    return spark.read.schema(NAME_PAIR_ROW).option("sep", "\t").option("quote", "").csv(path)
