"""The query of the surrogates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opsframe.llm.registry import query, table
from opsframe.llm.surrogates import replace_entities

#: Stands for the secret that a deployment reads from its own store.
KEY = "an example key, no secret"


@query()
def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), KEY)
