"""All queries of this package."""

from opsframe.llm import alignment_queries, bpe_queries, centroid_queries, chat_queries, jaccard_queries, leak_queries, line_queries, lm_queries, pii_queries, rule_queries, secret_queries, warc_queries  # noqa: F401
from opsframe.llm.registry import ORACLES, QUERIES

import corpus_pipeline

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

__all__ = ["ORACLES", "QUERIES"]
