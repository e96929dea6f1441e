"""The query of the n-gram Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opsframe.llm.jaccard_join import similar_documents
from opsframe.llm.registry import query, table


@query(
    """
    WITH RECURSIVE worded AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    sets AS (
        SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
        FROM worded),
    shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
    common AS (
        SELECT a.doc_id AS x, b.doc_id AS y, a.n AS xn, b.n AS yn, count(*) AS c
        FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (
        SELECT x, y FROM common WHERE 100 * c >= 80 * (xn + yn - c)
        UNION ALL SELECT y, x FROM common WHERE 100 * c >= 80 * (xn + yn - c)),
    reached AS (
        SELECT doc_id AS x, doc_id AS y FROM documents
        UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
    SELECT s.doc_id, len(s.s) AS n_shingles, min(r.y) AS component_id
    FROM sets s JOIN reached r ON s.doc_id = r.x GROUP BY ALL
    """
)
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))
