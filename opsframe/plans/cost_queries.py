"""Costs: purchases are the price history, all other events the traces of instances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.functions import times
from opsframe.operators import cost
from opsframe.plans import tables as t
from opsframe.plans.registry import query
from opsframe.plans.reports import cost_line as line_of_costs
from opsframe.plans.reports import run_report as report_of_run
from opsframe.sinks import text as sink
from opsframe.storage import scratch_path

PRICES = """prices AS (
  SELECT 'type' || user_id % 3 AS instance_type, user_id % 5 AS zone, ts, value AS price FROM events WHERE event_type = 'purchase')"""


def _costs(lifetimes: str) -> str:
    """SQL of the naive form: every price of the zone within the lifetime."""
    return f"""
lifetimes AS ({lifetimes}),
costs AS (
  SELECT l.*, coalesce(p.n, 0) AS prices, coalesce(p.total / p.n, 0) AS avg_price,
         date_diff('second', date_trunc('second', l.start), date_trunc('second', l.stop)) / 3600.0::DOUBLE AS hours
  FROM lifetimes l LEFT JOIN (
    SELECT l.metric, l.id, count(p.price) AS n, sum(p.price::DECIMAL(28, 12))::DOUBLE AS total
    FROM lifetimes l JOIN prices p ON p.instance_type = l.instance_type AND p.zone = l.zone AND p.ts BETWEEN l.start AND l.stop GROUP BY ALL
  ) p ON p.id = l.id AND p.metric IS NOT DISTINCT FROM l.metric)
"""


BY_USER = _costs("""
  SELECT NULL::VARCHAR AS metric, user_id AS id, 'type' || user_id % 3 AS instance_type, user_id % 5 AS zone, min(ts) AS start, max(ts) AS stop
  FROM events WHERE event_type <> 'purchase' GROUP BY ALL""")
BY_SERIES = _costs("""
  SELECT event_type AS metric, user_id AS id, 'type' || user_id % 3 AS instance_type, user_id % 5 AS zone, min(ts) AS start, max(ts) AS stop
  FROM events WHERE event_type <> 'purchase' GROUP BY ALL""")


def instance_costs(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    lifetimes = t.used(spark, sf_dir).groupBy(*keys).agg(F.min("ts").alias("start"), F.max("ts").alias("stop"))
    return cost.spot_cost(lifetimes.select("*", t.instance_type(), t.zone()), t.prices(spark, sf_dir))


def _four(column: str) -> Column:
    """Four places, by operations on doubles that give the same everywhere: what ``round`` does with a half depends."""
    return (F.floor(F.col(column) * 10000 + 0.5) / F.lit(10000.0)).alias(column)


@query(f"""
WITH {PRICES}, {BY_USER}
SELECT id, instance_type, zone, start, stop, prices, round(avg_price, 6) AS avg_price, round(hours, 6) AS hours,
       floor(hours * avg_price * 10000 + 0.5) / 10000 AS cost
FROM costs
""")
def spot_cost(spark, sf_dir):
    return instance_costs(spark, sf_dir, "id").select(
        "id", "instance_type", "zone", "start", "stop", "prices", t.r("avg_price"), t.r("hours"), _four("cost")
    )


@query(f"WITH {PRICES}, {BY_SERIES} SELECT metric, id, floor(hours * avg_price * 10000 + 0.5) / 10000 AS cost FROM costs")
def series_cost(spark, sf_dir):
    return instance_costs(spark, sf_dir, "metric", "id").select("metric", "id", _four("cost"))


@query(f"""
WITH {PRICES}, {BY_SERIES}
SELECT round(median(cost), 2) AS cost FROM (SELECT metric, sum(hours * avg_price) AS cost FROM costs GROUP BY metric)
""")
def fleet_cost_median(spark, sf_dir):
    return cost.fleet_cost_median(instance_costs(spark, sf_dir, "metric", "id"))


@query(f"""
WITH {PRICES}, {BY_SERIES}
SELECT printf('Cost:' || chr(9) || '~$%.2f', round(median(cost), 2)) AS line
FROM (SELECT metric, sum(hours * avg_price) AS cost FROM costs GROUP BY metric)
""")
def cost_line(spark, sf_dir):
    return line_of_costs(instance_costs(spark, sf_dir, "metric", "id"))


REPORT = f"""
WITH {PRICES}, {BY_USER},
run AS (
  SELECT (SELECT count(*) FROM documents) AS samples, count(*) AS nodes, arg_min(avg_price, id) AS avg_price,
         arg_min(hours * avg_price, id) AS instance_cost, arg_min(zone, id) AS zone, min(start) AS start, max(stop) AS stop
  FROM costs),
lines AS (
  SELECT unnest([
    {{'place': 1, 'label': 'Number of Samples', 'value': samples::VARCHAR}},
    {{'place': 2, 'label': 'Number of Nodes', 'value': nodes::VARCHAR}},
    {{'place': 5, 'label': 'Average Hourly Cost', 'value': printf('$%.4f', avg_price)}},
    {{'place': 6, 'label': 'Cost per Instance', 'value': printf('$%.4f', instance_cost)}},
    {{'place': 7, 'label': 'Availability Zone', 'value': zone::VARCHAR}},
    {{'place': 8, 'label': 'Start Time', 'value': strftime(start, '%Y-%m-%dT%H:%M:%S')}},
    {{'place': 9, 'label': 'Stop Time', 'value': strftime(stop, '%Y-%m-%dT%H:%M:%S')}},
    {{'place': 10, 'label': 'Total Cost of Cluster', 'value': printf('$%.4f', instance_cost * nodes)}},
    {{'place': 11, 'label': 'Cost Per Sample', 'value': printf('$%.4f', instance_cost * nodes / samples)}}
  ]) AS line FROM run)
"""


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = t.objects(spark, sf_dir).agg(F.count(F.lit(1)).alias("samples")).scalar()
    run = (
        instance_costs(spark, sf_dir, "id")
        .agg(
            F.count(F.lit(1)).alias("nodes"),
            F.min_by("avg_price", "id").alias("avg_price"),
            F.min_by("cost", "id").alias("instance_cost"),
            F.min_by("zone", "id").alias("zone"),
            F.date_format(F.min("start"), times.ISO).alias("start_iso"),
            F.date_format(F.max("stop"), times.ISO).alias("stop_iso"),
        )
        .withColumn("samples", samples)
    )
    return report_of_run(run)


@query(REPORT + "SELECT line.place AS place, line.label AS label, line.value AS value FROM lines")
def run_report(spark, sf_dir):
    return report(spark, sf_dir)


@query(REPORT + "SELECT line.label || ': ' || line.value AS line FROM lines")
def report_sink(spark, sf_dir):
    path = scratch_path(spark, "report")
    sink.write_report(report(spark, sf_dir), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("""
SELECT user_id AS id, ts, value AS price FROM events
WHERE event_type = 'purchase' AND ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-01'
""")
def price_scan(spark, sf_dir):
    history = t.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), F.col("event_type").alias("instance_type"), "ts", F.col("value").alias("price")
    )
    start, stop = (F.lit(text).cast("timestamp_ntz") for text in ("2024-01-01 00:00:00", "2024-02-01 00:00:00"))
    return cost.price_scan(history, "purchase", start=start, stop=stop).select("id", "ts", "price")


@query("""
SELECT user_id AS id, round(date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts)))
                            / 3600.0::DOUBLE, 6) AS hours
FROM events GROUP BY ALL
""")
def duration_hours(spark, sf_dir):
    spans = t.points(spark, sf_dir).groupBy("id").agg(F.min("ts").alias("start"), F.max("ts").alias("stop"))
    return spans.select("id", t.r(times.hours_between(F.col("start"), F.col("stop"))).alias("hours"))


STATE = "CASE o_orderstatus WHEN 'F' THEN 'terminated' WHEN 'P' THEN 'stopped' ELSE 'running' END"


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as instances that name their stop time in a reason."""
    state = F.when(F.col("o_orderstatus") == "F", "terminated").when(F.col("o_orderstatus") == "P", "stopped")
    ended = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return t.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.lit("1992-01-01T00:00:00.000Z").alias("launch_time"),
        state.otherwise("running").alias("state"),
        F.concat(F.lit("User initiated ("), ended, F.lit(" GMT)")).alias("reason"),
    )


NOW = "2002-01-01 00:00:00"


@query(f"""
SELECT DISTINCT l_orderkey AS id, TIMESTAMP '1992-01-01' AS start,
       CASE WHEN {STATE} = 'running' THEN TIMESTAMP '{NOW}' ELSE o_orderdate END AS stop
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def instance_spans(spark, sf_dir):
    ids = t.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id")).distinct()
    return cost.instance_spans(ids, instances(spark, sf_dir), F.lit(NOW).cast("timestamp_ntz"))


@query(f"""
SELECT o_orderkey, {STATE} AS state,
       CASE WHEN {STATE} = 'running' THEN '2002-01-01T00:00:00.000Z'
            ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000Z' END AS stop
FROM orders
""")
def stop_time(spark, sf_dir):
    now = F.lit(NOW).cast("timestamp_ntz")
    stop = times.stop_time(F.col("state"), F.col("reason"), now)
    return instances(spark, sf_dir).select(F.col("id").alias("o_orderkey"), "state", stop.alias("stop"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso FROM orders")
def iso_time(spark, sf_dir):
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return t.table(spark, sf_dir, "orders").select("o_orderkey", times.iso_from_text(text).alias("iso"))


@query("""
SELECT event_id, ts, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, ts::DATE AS day FROM events
""")
def epoch_time(spark, sf_dir):
    epoch = t.table(spark, sf_dir, "events").select(
        "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("seconds")
    )
    ts = times.epoch_to_time(F.col("seconds"))
    return epoch.select(
        "event_id", ts.alias("ts"), F.date_format(ts, times.ISO).alias("iso"), F.to_date(ts).alias("day")
    )
