"""The query of the WARC writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.registry import query, table
from opsframe.llm.warc import read_warc, write_warc
from opsframe.storage import scratch_path


@query(
    """
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
    hashed AS (SELECT page_id, strlen(p) AS payload_bytes, sha1(p) AS h FROM payloads),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM hashed)
    SELECT page_id, payload_bytes,
        list_aggregate(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(h, (j // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (j % 4))) & 31)::BIGINT, 1)),
            'string_agg', '') AS payload_digest,
        CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to
    FROM firsts
    """
)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = scratch_path(spark, "warc")
    records = read_warc(write_warc(table(spark, sf_dir, "pages"), uri, min_revisit_bytes=0), uri)
    return records.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
