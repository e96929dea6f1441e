"""The query of the centroid clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opsframe.llm.centroids import centroid_clusters, centroid_digest
from opsframe.llm.registry import query, table

K, ROUNDS, DIMS = 40, 5, 64


def _sql() -> str:
    """The rounds one after the other, each as an assignment by all distances and a move to the means."""
    nearest = """
    near{n} AS MATERIALIZED (SELECT nr, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
        SELECT nr, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
        FROM vectors, at{n}) GROUP BY nr)"""
    move = """
    sums{n} AS MATERIALIZED (SELECT c, i, sum(x) AS s, count(*) AS n FROM (
        SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{n} JOIN vectors USING (nr)) GROUP BY c, i),
    at{next} AS MATERIALIZED (SELECT at{n}.c, coalesce(moved.m, at{n}.m) AS m FROM at{n} LEFT JOIN (
        SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM sums{n} GROUP BY c) AS moved USING (c))"""
    rounds = [nearest.format(n=n) + "," + move.format(n=n, next=n + 1) for n in range(ROUNDS)]
    return f"""
    WITH vectors AS MATERIALIZED (
        SELECT vec_id, row_number() OVER () AS nr, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings WHERE len(embedding) = {DIMS}
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}),
    at0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v AS m
        FROM vectors WHERE vec_id IS NOT NULL QUALIFY c < {K}),
    {",".join(rounds)},{nearest.format(n=ROUNDS)}
    SELECT vec_id, c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
        sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
    FROM near{ROUNDS} JOIN vectors USING (nr) JOIN at{ROUNDS} USING (c)
    """


@query(_sql())
def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroid_clusters(table(spark, sf_dir, "embeddings"), k=K, rounds=ROUNDS, dims=DIMS)
    return found.withColumn("centroid_sha256", centroid_digest(found["centroid"])).drop("centroid")
