"""Fleet metrics over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.operators import fleet, inventory, series
from opsframe.plans import tables as t
from opsframe.plans.registry import query
from opsframe.plans.reports import fleet_report

DAILY = """
WITH grid AS (
  SELECT event_type AS metric, user_id AS id, date_trunc('day', ts)::TIMESTAMP AS ts, arg_min(value, event_id) AS value
  FROM events WHERE value IS NOT NULL GROUP BY ALL)
"""
BAND = DAILY + """, band AS (
  SELECT metric, ts, avg(value) AS mean, coalesce(stddev_samp(value), 0) AS std, count(*) AS n
  FROM grid GROUP BY ALL)
"""
PERIODS = """
WITH averages AS (
  SELECT event_type AS metric, user_id AS id, time_bucket(INTERVAL '300 seconds', ts)::TIMESTAMP AS ts, avg(value) AS value
  FROM events WHERE value IS NOT NULL GROUP BY ALL)
"""


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.grid_dedup(t.daily(t.points(spark, sf_dir)), "event_id")


def band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.fleet_band(grid(spark, sf_dir))


def averages(spark: SparkSession, sf_dir: str, period: str = series.PERIOD) -> DataFrame:
    return series.metric_period_avg(t.points(spark, sf_dir), period).drop("namespace")


@query(DAILY + "SELECT * FROM grid")
def grid_dedup(spark, sf_dir):
    return grid(spark, sf_dir)


@query(DAILY + """,
times AS (SELECT DISTINCT ts FROM grid), series AS (SELECT DISTINCT metric, id FROM grid)
SELECT metric, id, count(*) AS n_times, string_agg(CASE WHEN value IS NULL THEN '0' ELSE '1' END, '' ORDER BY ts) AS present,
       string_agg(coalesce(printf('%.6f', value), ''), ',' ORDER BY ts) AS values
FROM series CROSS JOIN times LEFT JOIN grid USING (metric, id, ts) GROUP BY metric, id
""")
def grid_pivot(spark, sf_dir):
    aligned = fleet.aligned_grid(grid(spark, sf_dir))
    spelled = F.transform("values", lambda v: F.when(v.isNull(), "").otherwise(F.format_string("%.6f", v)))
    return aligned.select("metric", "id", F.size("values").cast("long").alias("n_times"), "present", F.array_join(spelled, ",").alias("values"))


@query(BAND + """
SELECT metric, ts, round(mean, 6) AS mean, round(std, 6) AS std, round(greatest(mean - std, 0), 6) AS lo,
       round(mean + std, 6) AS hi, n
FROM band
""")
def fleet_band(spark, sf_dir):
    return band(spark, sf_dir).select("metric", "ts", t.r("mean"), t.r("std"), t.r("lo"), t.r("hi"), "n")


@query(DAILY + "SELECT metric, ts, count(*) AS n FROM grid GROUP BY ALL")
def fleet_count(spark, sf_dir):
    return fleet.fleet_count(grid(spark, sf_dir))


@query(DAILY + """
SELECT ts, max(n) * 32 AS cores FROM (SELECT metric, ts, count(*) AS n FROM grid GROUP BY ALL) GROUP BY ts
""")
def fleet_capacity(spark, sf_dir):
    return fleet.fleet_capacity(grid(spark, sf_dir))


@query("SELECT event_type AS metric, user_id AS id, min(ts) AS start, max(ts) AS stop FROM events GROUP BY ALL")
def fleet_lifetime(spark, sf_dir):
    return fleet.fleet_lifetime(t.points(spark, sf_dir))


@query(BAND + """
SELECT metric, ts, round((row_number() OVER (PARTITION BY metric ORDER BY ts) - 1) * 5.0::DOUBLE / 60, 6) AS x_hours,
       round(date_diff('second', min(ts) OVER (PARTITION BY metric), ts) / 3600.0::DOUBLE, 6) AS real_hours
FROM band
""")
def elapsed_axis(spark, sf_dir):
    axis = fleet.elapsed_axis(band(spark, sf_dir).select("metric", "ts"))
    return axis.select("metric", "ts", t.r("x_hours"), t.r("real_hours"))


LABELS = ", ".join(f"({i}, '{unit}', '{title}')" for i, (unit, title) in enumerate(fleet.PANEL_LABELS, 1))
PANELS = f"""
panels AS (
  SELECT m.panel, m.metric, l.ylabel, l.title
  FROM (SELECT metric, row_number() OVER (ORDER BY metric) AS panel
        FROM (SELECT DISTINCT event_type AS metric FROM events)) m
  JOIN (VALUES {LABELS}) l(panel, ylabel, title) ON m.panel = l.panel)
"""


@query("WITH " + PANELS + "SELECT panel::INTEGER AS panel, metric, ylabel, title FROM panels")
def metric_info_zip(spark, sf_dir):
    return fleet.metric_info_zip(t.points(spark, sf_dir))


@query(BAND + ", " + PANELS + """
SELECT b.metric, b.ts, round(mean, 6) AS mean, round(greatest(mean - std, 0), 6) AS lo, round(mean + std, 6) AS hi,
       round((row_number() OVER (PARTITION BY b.metric ORDER BY ts) - 1) * 5.0::DOUBLE / 60, 6) AS x_hours, title
FROM band b LEFT JOIN panels p ON b.metric = p.metric
""")
def fleet_panels(spark, sf_dir):
    report = fleet_report(t.daily(t.points(spark, sf_dir)), "event_id")
    return report.select("metric", "ts", t.r("mean"), t.r("lo"), t.r("hi"), t.r("x_hours"), "title")


@query("SELECT user_id AS id, max(ts) AS mark FROM events GROUP BY ALL")
def high_water(spark, sf_dir):
    return fleet.high_water(t.points(spark, sf_dir))


@query("SELECT DISTINCT user_id AS id FROM events")
def distinct_ids(spark, sf_dir):
    return inventory.distinct_ids(t.points(spark, sf_dir))


@query("""
SELECT u.id, m.metric, coalesce(v.mark, TIMESTAMP '2024-01-31' - INTERVAL '1800 seconds') AS start
FROM (SELECT DISTINCT user_id AS id FROM events) u
CROSS JOIN (SELECT DISTINCT event_type AS metric FROM events) m
LEFT JOIN (
  SELECT user_id AS id, event_type AS metric, max(ts) AS mark FROM events GROUP BY ALL
) v ON v.id = u.id AND v.metric = m.metric
""")
def collection_plan(spark, sf_dir):
    points = t.points(spark, sf_dir)
    marks = fleet.high_water(points, "id", "metric")
    metrics = points.select("metric").distinct()
    start = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz") - F.expr("interval 1800 seconds")
    return fleet.collection_plan(inventory.distinct_ids(points), marks, metrics, start)


@query("""
SELECT 'fleet/events' AS namespace, event_type AS metric, user_id AS id,
       time_bucket(INTERVAL '300 seconds', ts)::TIMESTAMP AS ts, round(avg(value), 6) AS value
FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' GROUP BY ALL
""")
def metric_period_avg(spark, sf_dir):
    named = t.points(spark, sf_dir).withColumn("metric", F.concat(F.lit("fleet/events/"), "metric"))
    start, stop = (F.lit(text).cast("timestamp_ntz") for text in ("2024-01-01 00:00:00", "2024-02-01 00:00:00"))
    result = series.metric_period_avg(named, start=start, stop=stop)
    return result.select("namespace", "metric", "id", "ts", t.r("value"))


@query(PERIODS + """
SELECT metric, id, floor(epoch(ts) / 345600)::BIGINT AS page,
       string_agg(printf('%.6f', value), ',' ORDER BY ts) AS values
FROM averages GROUP BY ALL
""")
def metric_arrays(spark, sf_dir):
    arrays = series.metric_arrays(averages(spark, sf_dir))
    text = F.array_join(F.transform("values", lambda v: F.format_string("%.6f", v)), ",")
    return arrays.select("metric", "id", "page", text.alias("values"))


@query(PERIODS + """
SELECT metric, id, string_agg(printf('%.6f', value), ',' ORDER BY ts) AS line FROM averages GROUP BY ALL
""")
def ragged_csv(spark, sf_dir):
    return series.ragged_lines(series.metric_arrays(averages(spark, sf_dir)), "%.6f")


@query("""
SELECT event_type AS metric, user_id AS id, ts, value, event_id,
       row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS ordinal
FROM events
""")
def sorted_series(spark, sf_dir):
    return series.sorted_series(t.points(spark, sf_dir), "event_id")


PAGING = """
SELECT id, start, stop, page_start, page_start + INTERVAL '4 days' AS page_stop
FROM (SELECT id, start, stop, unnest(generate_series(start, stop, INTERVAL '4 days')) AS page_start
      FROM (SELECT user_id AS id, min(ts) AS start, max(ts) AS stop FROM events GROUP BY ALL))
WHERE page_start < stop
"""


@query(PAGING)
def metric_paging(spark, sf_dir):
    return series.metric_paging(spans(spark, sf_dir))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = t.points(spark, sf_dir)
    return points.groupBy("id").agg(F.min("ts").alias("start"), F.max("ts").alias("stop"))


@query(f"""
SELECT p.id, p.page_start, count(e.event_id) AS n, round(sum(e.value), 4) AS total
FROM ({PAGING}) p JOIN events e ON e.user_id = p.id AND e.ts >= p.page_start AND e.ts < p.page_stop
GROUP BY ALL
""")
def page_union(spark, sf_dir):
    paged = series.page_points(t.points(spark, sf_dir), spans(spark, sf_dir))
    return paged.groupBy("id", "page_start").agg(
        F.count("event_id").alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


@query("""
SELECT metric, id, max(value) AS max_value
FROM (SELECT event_type AS metric, user_id AS id, value,
             row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS place
      FROM events)
WHERE place <= 4 GROUP BY ALL HAVING count(*) = 4 AND max(value) < 60
""")
def idle_last4(spark, sf_dir):
    return series.idle_last(t.points(spark, sf_dir), "event_id", threshold=60.0)


@query("""
SELECT * FROM (
  SELECT event_type AS metric, user_id AS id, event_id,
         row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC)::INTEGER AS place
  FROM events)
WHERE place <= 4
""")
def top_k_per_key(spark, sf_dir):
    newest = [F.col("ts").desc(), F.col("event_id").desc()]
    top = series.top_k_per_key(t.points(spark, sf_dir), ["metric", "id"], *newest, k=4)
    return top.select("metric", "id", "event_id", "place")


@query("""
SELECT metric, id, ts, round(value, 6) AS value
FROM (SELECT *, count(*) OVER (PARTITION BY metric, id ORDER BY ts
                               RANGE BETWEEN INTERVAL '1 day' PRECEDING AND CURRENT ROW) AS n
      FROM (SELECT event_type AS metric, user_id AS id, date_trunc('day', ts)::TIMESTAMP AS ts, avg(value) AS value
            FROM events GROUP BY ALL)
      WHERE value < 30)
WHERE n = 2
""")
def alarm_breach(spark, sf_dir):
    hits = series.alarm_breach(
        averages(spark, sf_dir, "1 day"), threshold=30.0, period_seconds=86400, evaluation_periods=2
    )
    return hits.select("metric", "id", "ts", t.r("value"))


@query("SELECT event_type AS metric, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL")
def first_match(spark, sf_dir):
    return inventory.first_match(t.points(spark, sf_dir), "event_id", "ts", "metric")
