"""The query of the quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opsframe.llm.quality_rules import rule_quality
from opsframe.llm.registry import query, table


@query()
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rule_quality(table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", "quality", "votes")
