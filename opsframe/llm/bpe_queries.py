"""The query of the byte-level BPE."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.byte_bpe import encode, read_ranks, round_trip
from opsframe.llm.registry import query, table


@query()
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = round_trip(encode(table(spark, sf_dir, "documents"), public_tokenizers.PATTERN, ranks), ranks)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
