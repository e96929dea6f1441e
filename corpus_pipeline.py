"""From raw documents to token ids: quality, repeated lines, near copies, benchmark leaks, encoding.

Each stage takes and returns documents with all their columns, whatever their names; the last returns token ids.
Between stages the documents are written and read again.  Decisions are joined to the documents by id and text, so rows
that share an id are told apart where their texts differ.

Rows without an id are judged, and stay or go, like others; null and empty texts are what each operator says: the first
stage judges them as an end alone, they have no lines to lose, no near copies, hold no benchmark item, and have no ids.
Equal rows are treated alike.  A stage on an empty table returns an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.byte_bpe import encode, read_ranks, round_trip
from opsframe.llm.decontaminate import leaked_items
from opsframe.llm.jaccard_join import similar_documents
from opsframe.llm.leak_queries import benchmark_items
from opsframe.llm.line_dedup import apply_bitmaps, keep_bitmaps, text_hash
from opsframe.llm.lm_queries import low_ids, trusted_ids
from opsframe.llm.quality_lm import perplexity_quality
from opsframe.storage import cut_lineage


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` but the rows of the given ``doc_id`` and ``text_hash``."""
    gone = gone.select(F.col("doc_id").alias("_gone_id"), F.col("text_hash").alias("_gone_text")).distinct()
    gone = cut_lineage(gone, "gone")
    same = docs["doc_id"].eqNullSafe(gone["_gone_id"]) & (text_hash(docs["text"]) == gone["_gone_text"])
    return docs.join(gone, same, "left_anti")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are neither stranger nor more repetitive than their language's thresholds under trusted text."""
    judged = perplexity_quality(docs, trusted_ids(spark, sf_dir), low=low_ids(spark, sf_dir))
    return _without(docs, judged.filter("not kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more have; ``n_chars`` follows the text."""
    kept = apply_bitmaps(docs, keep_bitmaps(docs), counts=False)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; rows that repeat an id stay or go together."""
    found = similar_documents(docs)
    others = cut_lineage(found.filter("component_id <> doc_id").select("doc_id").distinct(), "copies")
    return docs.join(others, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is verified."""
    keyed = docs.select(F.struct("doc_id", text_hash(F.col("text")).alias("text_hash")).alias("key"), "text")
    found = leaked_items(keyed, benchmark_items(spark, sf_dir), doc_id="key").filter("verified")
    return _without(docs, found.select("doc_id.*"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256`` of every document."""
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = round_trip(encode(docs, public_tokenizers.PATTERN, ranks), ranks)
    return encoded.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", byte_bpe),
]

#: The first stage scores a trained model, which SQL cannot say; the tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
