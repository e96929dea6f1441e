"""The given tables in the roles the operators ask for.

Each view names only the columns it needs, so the scan reads no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.operators.records import text_lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as metric points: type is the metric, user the instance."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("metric"), F.col("user_id").alias("id"), "ts", "value", "event_id"
    )


def daily(df: DataFrame) -> DataFrame:
    """Times cut to the day."""
    return df.withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))


def r(column: str | Column, digits: int = 6) -> Column:
    """Rounded, so that the order of a floating point sum does not show."""
    name = column if isinstance(column, str) else None
    rounded = F.round(F.col(column) if name else column, digits)
    return rounded.alias(name) if name else rounded


def zone(user: str = "id") -> Column:
    return (F.col(user) % 5).alias("zone")


def instance_type(user: str = "id") -> Column:
    return F.concat(F.lit("type"), (F.col(user) % 3).cast("string")).alias("instance_type")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as price history."""
    bought = points(spark, sf_dir).filter(F.col("metric") == "purchase")
    return bought.select(instance_type(), zone(), "ts", F.col("value").alias("price"))


def used(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All other events, as the traces an instance leaves."""
    return points(spark, sf_dir).filter(F.col("metric") != "purchase")


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as an object listing."""
    key = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".tar.gz"))
    return table(spark, sf_dir, "documents").select("doc_id", key.alias("key"), F.col("n_chars").alias("size"))


def labelled_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects that are at the target already: labelled documents."""
    return table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("key"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_lines(table(spark, sf_dir, "documents"), "doc_id", "text")


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url")
