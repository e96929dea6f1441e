"""Manifests and batches: orders and documents as samples."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.operators import manifest, ordered
from opsframe.plans import tables as t
from opsframe.plans.registry import query
from opsframe.sinks import text as sink
from opsframe.sinks.metric_files import append_metric_files
from opsframe.sources import manifests, metrics
from opsframe.storage import scratch_path


def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as manifest lines: open ones as comments, pending ones blank, the rest indented samples."""
    layout = F.when(F.col("o_orderpriority") == "5-LOW", "SINGLE").otherwise("PAIRED")
    sample = F.concat_ws("\t", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), layout)
    line = (
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("# "), sample))
        .when(F.col("o_orderstatus") == "P", F.lit(" \t "))
        .otherwise(F.concat(F.lit("  "), sample, F.lit(" \r")))
    )
    return t.table(spark, sf_dir, "orders").select(line.alias("line"))


MANIFEST = """
SELECT o_orderkey::VARCHAR AS run, o_custkey::VARCHAR AS project,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'SINGLE' ELSE 'PAIRED' END AS layout
FROM orders WHERE o_orderstatus NOT IN ('O', 'P')
"""


@query(MANIFEST)
def manifest_scan(spark, sf_dir):
    return manifest.manifest_rows(manifest_lines(spark, sf_dir))


@query("SELECT o_orderkey::VARCHAR AS id FROM orders")
def gdc_manifest_scan(spark, sf_dir):
    path = scratch_path(spark, "gdc")
    rows = t.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("state"))
    rows.write.option("header", "true").option("sep", "\t").csv(path)
    return manifests.read_gdc_manifest(spark, path)


@query("""
WITH samples AS (
  SELECT 'SRR' || lpad(o_orderkey::VARCHAR, 7, '0') AS run,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 'PRJ' || o_custkey END AS project,
         CASE WHEN o_orderstatus = 'F' THEN 'PAIRED' ELSE 'SINGLE' END AS layout
  FROM orders)
SELECT run, project, layout, layout = 'PAIRED' AS paired,
       's3://out/experiments/' || coalesce(project, 'unassigned') AS output_dir,
       'ftp://ftp-trace.ncbi.nih.gov/sra/sra-instant/reads/ByRun/sra/' || substr(run, 1, 3) || '/' || substr(run, 1, 6)
       || '/' || substr(run, 1, 10) || '/' || run || '.sra' AS url
FROM samples
""")
def manifest_derive(spark, sf_dir):
    project = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", manifest.MISSING_PROJECT).otherwise(
        F.concat(F.lit("PRJ"), F.col("o_custkey").cast("string"))
    )
    samples = t.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("SRR"), F.lpad(F.col("o_orderkey").cast("string"), 7, "0")).alias("run"),
        project.alias("project"),
        F.when(F.col("o_orderstatus") == "F", "PAIRED").otherwise("SINGLE").alias("layout"),
    )
    return manifest.manifest_derive(samples, "s3://out/")


@query("SELECT o_orderkey, ntile(10) OVER (ORDER BY o_orderkey)::INTEGER AS tile FROM orders")
def ntile_partition(spark, sf_dir):
    return ordered.ntile_partition(t.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", tiles=10)


@query("""
WITH numbered AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS place, count(*) OVER () AS n FROM orders),
one AS (SELECT *, n // 100 AS size1, place // greatest(n // 100, 1) AS chunk1 FROM numbered),
two AS (SELECT *, place - chunk1 * size1 AS place2, least(size1, n - chunk1 * size1) AS len2 FROM one),
three AS (SELECT *, len2 // 100 AS size2 FROM two)
SELECT o_orderkey,
       CASE WHEN size1 <= 1 THEN '' WHEN size2 <= 1 THEN chunk1::VARCHAR ELSE chunk1 || '/' || (place2 // size2) END AS chunk
FROM three
""")
def chunk_assign(spark, sf_dir):
    chunks = ordered.chunk_assign(t.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    path = F.array_join(F.col("chunk_path").cast("array<string>"), "/")
    return chunks.select("o_orderkey", path.alias("chunk"))


@query("SELECT doc_id, length(text)::BIGINT AS length, 'run' AS tag FROM documents")
def map_samples(spark, sf_dir):
    def text_length(batch: pd.DataFrame, tag: str) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": batch["doc_id"], "length": batch["text"].str.len(), "tag": tag})

    samples = t.table(spark, sf_dir, "documents").select("doc_id", "text")
    return manifest.map_samples(samples, text_length, "doc_id long, length long, tag string", "run")


@query("""
SELECT source AS project, count(*) AS n, coalesce(sum(length(text)), 0)::BIGINT AS length, 'run' AS tag
FROM documents GROUP BY source
""")
def map_projects(spark, sf_dir):
    def totals(project: str, batches: Iterator[pa.RecordBatch], tag: str) -> Iterator[pa.RecordBatch]:
        n = length = 0
        for batch in batches:
            n += batch.num_rows
            length += pc.sum(pc.utf8_length(batch.column("text"))).as_py() or 0
        names = pa.schema({"project": pa.string(), "n": pa.int64(), "length": pa.int64(), "tag": pa.string()})
        yield pa.RecordBatch.from_pylist([{"project": project, "n": n, "length": length, "tag": tag}], names)

    samples = t.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("project"), "text")
    schema = "project string, n long, length long, tag string"
    partial = manifest.map_projects(samples, totals, schema, "run", parts=16, spread=["doc_id"])
    return partial.groupBy("project", "tag").agg(F.sum("n").alias("n"), F.sum("length").alias("length"))


@query("SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS product FROM lineitem")
def udf_multiply(spark, sf_dir):
    lines = t.table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", manifest.multiply("l_quantity", "l_extendedprice").alias("product"))


@query("SELECT event_type AS metric, user_id::VARCHAR AS id, ts, value FROM events")
def metric_tsv_scan(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    append_metric_files(t.points(spark, sf_dir), path)
    return metrics.read_metric_files(spark, path)


@query("""
SELECT event_type AS metric, user_id::VARCHAR AS id, ts, value FROM events
UNION ALL SELECT event_type AS metric, user_id::VARCHAR AS id, ts, value FROM events WHERE event_type = 'view'
""")
def metric_tsv_append(spark, sf_dir):
    # A second collection delivers one metric again; appending keeps both.  An append that runs again adds nothing.
    path = scratch_path(spark, "metrics")
    points = t.points(spark, sf_dir)
    append_metric_files(points, path, "first")
    for _ in range(2):
        append_metric_files(points.filter(F.col("metric") == "view"), path, "second")
    return metrics.read_metric_files(spark, path)


@query("SELECT event_id, value, 'run-1' AS run_id, ts::DATE AS run_date FROM events")
def run_dir(spark, sf_dir):
    path = f"{scratch_path(spark, 'runs')}/{sink.run_name('cluster', 'run-1', '2024-01-31')}"
    rows = sink.with_run(t.points(spark, sf_dir).select("event_id", "value", "ts"), "run-1", F.col("ts")).drop("ts")
    rows.write.partitionBy("run_id", "run_date").parquet(path)
    return spark.read.schema(rows.schema).parquet(path).select("event_id", "value", "run_id", "run_date")
