"""The queries of the language models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.kneser_ney import language_scores
from opsframe.llm.quality_lm import perplexity_quality
from opsframe.llm.registry import query, table


def low_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that every label calls low-quality."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"))
    return labels.filter("q = 0").select("doc_id")


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that every label calls good and none toxic."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    return labels.filter("q = 1 and t = 0").select("doc_id")


@query()
def op8_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return perplexity_quality(docs, trusted_ids(spark, sf_dir), low=low_ids(spark, sf_dir)).drop("text_hash")


@query()
def op5_language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))
