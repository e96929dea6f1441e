"""The query of the tokenizer alignment."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opsframe.llm.alignment import link_statistics
from opsframe.llm.registry import query, table


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return link_statistics(table(spark, sf_dir, "documents"), first, second)
