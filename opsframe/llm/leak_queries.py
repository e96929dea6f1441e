"""The query of the benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.decontaminate import leaked_items, split_answer
from opsframe.llm.registry import query, table


def benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark with each text as question and answer."""
    question, answer = split_answer(F.col("text"))
    return table(spark, sf_dir, "benchmark").select("item_id", question.alias("question"), answer.alias("answer"))


@query()
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaked_items(table(spark, sf_dir, "documents"), benchmark_items(spark, sf_dir))
    return found.filter("verified").select("doc_id", "item_id", "score", "question_overlap", "answer_overlap")
