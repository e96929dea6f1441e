"""The events table as a stream of metric points, read to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.plans import tables as t
from opsframe.plans.registry import query
from opsframe.sources import metrics
from opsframe.storage import scratch_path
from opsframe.streaming import merged
from opsframe.streaming import operators as ops
from opsframe.streaming import run as runs

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
HOUR = 3600


def stream_of_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = runs.read_points(spark, sf_dir, EVENTS, "events.parquet")
    named = events.select(
        F.col("event_type").alias("metric"), F.col("user_id").alias("id"), "ts", "value", "event_id"
    )
    return ops.with_event_time(named)


def read_batches(spark: SparkSession, stream: DataFrame, label: str, **options) -> DataFrame:
    path = scratch_path(spark, label)
    runs.update_batches(stream, f"{path}/rows", f"{path}/state", available_now=True, **options).awaitTermination()
    return spark.read.parquet(f"{path}/rows")


def read_sums(spark: SparkSession, stream: DataFrame, label: str, partial: merged.Reduce, merge: merged.Reduce) -> DataFrame:
    path = scratch_path(spark, label)
    merged.merge_batches(stream, f"{path}/rows", f"{path}/state", partial, merge, available_now=True).awaitTermination()
    return merged.read_merged(spark, f"{path}/rows", merge)


def no_zone(df: DataFrame, column: str = "ts") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


@query("SELECT user_id AS id, event_type AS metric, max(ts) AS mark FROM events GROUP BY ALL")
def stream_high_water(spark, sf_dir):
    marks = read_sums(spark, stream_of_points(spark, sf_dir), "marks", ops.high_water, ops.merge_marks)
    return no_zone(marks, "mark")


@query("""
SELECT event_type AS metric, user_id AS id, time_bucket(INTERVAL '300 seconds', ts)::TIMESTAMP AS ts,
       round(avg(value), 6) AS value
FROM events GROUP BY ALL
""")
def stream_period_avg(spark, sf_dir):
    batches = read_batches(spark, ops.period_avg(stream_of_points(spark, sf_dir)), "averages")
    newest = runs.latest(batches, "metric", "id", "ts")
    return no_zone(newest).select("metric", "id", "ts", t.r("value"))


@query("""
SELECT event_type AS metric, user_id AS id, time_bucket(INTERVAL '300 seconds', ts)::TIMESTAMP AS ts,
       round(avg(value), 6) AS value
FROM events GROUP BY ALL
""")
def stream_period_merge(spark, sf_dir):
    # Without a watermark: points that come late are merged like all others.
    stream = stream_of_points(spark, sf_dir)
    sums = read_sums(spark, stream, "sums", ops.period_sums, ops.merge_period_sums)
    return no_zone(ops.averages_of_sums(sums)).select("metric", "id", "ts", t.r("value"))


@query("SELECT DISTINCT event_type AS metric, user_id AS id, ts, value, event_id FROM events")
def stream_dedup(spark, sf_dir):
    # Every point arrives twice, as from overlapping polls; copies have the key of the original.
    points = stream_of_points(spark, sf_dir)
    twice = points.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    path = scratch_path(spark, "dedup")
    runs.append_files(ops.dedup(twice), f"{path}/rows", f"{path}/state", by=["metric"], available_now=True).awaitTermination()
    kept = spark.read.parquet(f"{path}/rows")
    return no_zone(kept).select(F.col("metric").cast("string").alias("metric"), "id", "ts", "value", "event_id")


@query("""
SELECT metric, id, max(value) AS max_value
FROM (SELECT event_type AS metric, user_id AS id, value,
             row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS place
      FROM events WHERE event_type = 'view')
WHERE place <= 4 GROUP BY ALL HAVING count(*) = 4 AND max(value) < 60
""")
def stream_idle(spark, sf_dir):
    def idle(batch: DataFrame) -> DataFrame:
        return ops.idle_candidates(batch, "view", "event_id", threshold=60.0)

    batches = read_batches(spark, stream_of_points(spark, sf_dir), "idle", per_batch=idle, mode="append")
    return batches.select("metric", "id", "max_value").distinct()


@query("SELECT event_type AS metric, user_id::VARCHAR AS id, ts, value FROM events")
def stream_demux_append(spark, sf_dir):
    path = scratch_path(spark, "demux")
    points = stream_of_points(spark, sf_dir)
    rows = points.select(
        F.col("id").cast("string").alias("id"), "value", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "metric"
    )
    runs.append_files(
        rows, f"{path}/rows", f"{path}/state", by=["metric"], file_format="csv", available_now=True, sep="\t"
    ).awaitTermination()
    return metrics.read_metric_table(spark, f"{path}/rows")


@query(f"""
WITH averages AS (
  SELECT event_type AS metric, user_id AS id, time_bucket(INTERVAL '6 hours', ts)::TIMESTAMP AS ts, avg(value) AS value
  FROM events GROUP BY ALL),
hits AS (
  SELECT *, count(*) OVER (PARTITION BY metric, id ORDER BY ts
                           RANGE BETWEEN INTERVAL '6 hours' PRECEDING AND CURRENT ROW) AS n
  FROM averages WHERE value < 30)
SELECT metric, id, ts, round(value, 6) AS value FROM hits
WHERE n = 2 AND ts + INTERVAL '6 hours' <= (SELECT max(ts) - INTERVAL '1 hour' FROM events)
""")
def stream_alarm(spark, sf_dir):
    # Only closed periods raise an alarm: those that end before the watermark.
    alarms = ops.alarm(
        stream_of_points(spark, sf_dir), threshold=30.0, period_seconds=6 * HOUR, evaluation_periods=2
    )
    path = scratch_path(spark, "alarms")
    runs.use_keyed_state(spark)
    runs.append_files(alarms, f"{path}/rows", f"{path}/state", available_now=True).awaitTermination()
    return no_zone(spark.read.schema(alarms.schema).parquet(f"{path}/rows")).select("metric", "id", "ts", t.r("value"))
