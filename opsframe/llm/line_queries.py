"""The query of the line dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.line_dedup import apply_bitmaps, keep_bitmaps
from opsframe.llm.registry import query, table


@query(
    """
    WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    each AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
    keyed AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM each),
    frequent AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
    SELECT doc_id, count(*) AS n_lines, count(frequent.key) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE frequent.key IS NULL), '')) AS kept_sha256
    FROM keyed LEFT JOIN frequent ON keyed.key = frequent.key GROUP BY doc_id
    """
)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = apply_bitmaps(docs, keep_bitmaps(docs, min_docs=10, min_chars=1))
    return kept.select(
        "doc_id",
        F.col("lines_before").alias("n_lines"),
        F.col("lines_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )
