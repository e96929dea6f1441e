"""Line records: documents split into lines, lineitems written as lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.operators import records
from opsframe.plans import tables as t
from opsframe.plans.registry import query
from opsframe.sinks import text as sink
from opsframe.sources import lines as numbered
from opsframe.storage import scratch_path

LINES = """
lines AS (
  SELECT doc_id AS file, unnest(range(0, len(parts))) AS ordinal, len(parts) AS n_lines, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
"""
MATES = LINES + """, mates AS (
  SELECT file, CASE WHEN ordinal % 8 < 4 THEN 1 ELSE 2 END AS mate, (ordinal // 8) * 4 + ordinal % 4 AS mate_ordinal, line
  FROM lines WHERE ordinal < n_lines - n_lines % 8)
"""
RULES = (("The", "aws:us-west-2:run"), ("Re", "--s3_dir out"))


@query(f"""
WITH {LINES}, placed AS (SELECT row_number() OVER (ORDER BY file, ordinal) - 1 AS ordinal, line FROM lines)
SELECT ordinal, ordinal // 4 AS read, (ordinal % 4)::INTEGER AS field, line FROM placed
""")
def fastq_scan(spark, sf_dir):
    # The lines as text files that follow each other; a read may begin in one file, or one block, and end in the next.
    path = scratch_path(spark, "reads")
    lines = t.document_lines(spark, sf_dir).filter("line is not null").repartitionByRange("file", "ordinal")
    lines.sortWithinPartitions("file", "ordinal").select("line").write.text(path)
    placed = numbered.in_sequence(numbered.read_lines(spark, path))
    return records.fastq_reads(placed.select(F.col("place").alias("ordinal"), "line"))


@query(f"WITH {MATES} SELECT file, mate, mate_ordinal, line FROM mates")
def deinterleave(spark, sf_dir):
    return records.deinterleave(t.document_lines(spark, sf_dir))


@query(f"WITH {MATES} SELECT mate, line FROM mates")
def gzip_demux(spark, sf_dir):
    path = scratch_path(spark, "mates")
    sink.write_mates(records.deinterleave(t.document_lines(spark, sf_dir)), path)
    return spark.read.schema("value string, mate int").text(path).select("mate", F.col("value").alias("line"))


@query(f"WITH {LINES} SELECT file, ordinal, line FROM lines WHERE ordinal < 8")
def head_lines(spark, sf_dir):
    return records.head_lines(t.document_lines(spark, sf_dir), 8).select("file", "ordinal", "line")


@query(f"WITH {LINES} SELECT file, ordinal, line FROM lines WHERE regexp_matches(line, '^The\\b')")
def chrom_filter_gtf(spark, sf_dir):
    return records.chrom_filter_gtf(t.document_lines(spark, sf_dir), "The").select("file", "ordinal", "line")


@query("""
SELECT l_orderkey AS file, CASE WHEN l_linenumber = 1 THEN '##' || l_orderkey
       ELSE l_returnflag || chr(9) || l_partkey || chr(9) || l_linestatus END AS line
FROM lineitem WHERE l_linenumber = 1 OR l_returnflag = 'A'
""")
def chrom_filter_vcf(spark, sf_dir):
    row = F.concat_ws("\t", "l_returnflag", F.col("l_partkey").cast("string"), "l_linestatus")
    header = F.concat(F.lit("##"), F.col("l_orderkey").cast("string"))
    lines = t.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("file"), F.when(F.col("l_linenumber") == 1, header).otherwise(row).alias("line")
    )
    return records.chrom_filter_vcf(lines, "A")


@query(f"""
WITH {LINES} SELECT file, ordinal, CASE WHEN starts_with(line, '{RULES[0][0]}') THEN '{RULES[0][1]}'
  WHEN starts_with(line, '{RULES[1][0]}') THEN '{RULES[1][1]}' ELSE line END AS line
FROM lines
""")
def line_rewrite(spark, sf_dir):
    return records.line_rewrite(t.document_lines(spark, sf_dir), RULES).select("file", "ordinal", "line")


@query("SELECT o_orderkey::VARCHAR AS line, row_number() OVER (ORDER BY o_orderkey) - 1 AS place FROM orders")
def line_ordinals(spark, sf_dir):
    # Order keys as text files that follow each other in key order, read back with
    # their line numbers.
    path = scratch_path(spark, "text")
    keys = t.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("line"), "o_orderkey")
    keys.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").select("line").write.text(path)
    return numbered.in_sequence(numbered.read_lines(spark, path)).select("line", "place")
