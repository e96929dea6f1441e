"""Costs: interval edges, missing prices, and agreement with the plain join."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsframe.functions import times
from opsframe.operators import cost
from opsframe.plans.reports import run_report

T0 = datetime(2024, 1, 1)
LIFE = "id string, instance_type string, zone string, start timestamp_ntz, stop timestamp_ntz"
PRICE = "instance_type string, zone string, ts timestamp_ntz, price double"


def at(hours):
    return T0 + timedelta(hours=hours)


@pytest.fixture
def prices(spark):
    return spark.createDataFrame(
        [
            ("big", "a", at(0), 1.0),  # exactly at the start
            ("big", "a", at(1), 2.0),
            ("big", "a", at(1), 4.0),  # same time
            ("big", "a", at(2), 5.0),  # exactly at the stop
            ("big", "a", at(3), 100.0),
            ("big", "b", at(1), 7.0),  # other zone
            ("small", "a", at(1), 9.0),  # other type
        ],
        PRICE,
    )


def test_edges_count_and_other_zones_do_not(spark, prices):
    lives = spark.createDataFrame(
        [("i1", "big", "a", at(0), at(2)), ("i2", "big", "c", at(0), at(2)), ("i3", "big", "a", at(1), at(1)),
         ("i4", "big", "a", at(0.5), at(0.75)), ("i5", "big", "b", at(0), at(30 * 24))], LIFE)
    got = {r.id: (r.prices, r.avg_price, r.hours, r.cost) for r in cost.spot_cost(lives, prices).collect()}
    assert got == {
        "i1": (4, 3.0, 2.0, 6.0),
        "i2": (0, 0.0, 2.0, 0.0),  # no prices in the zone
        "i3": (2, 3.0, 0.0, 0.0),
        "i4": (0, 0.0, 0.25, 0.0),  # no prices in the time
        "i5": (1, 7.0, 720.0, 5040.0),
    }


def test_equal_lifetimes_stay_apart(spark, prices):
    lives = spark.createDataFrame([("i1", "big", "a", at(0), at(2)), ("i1", "big", "a", at(0), at(2))], LIFE)
    assert [r.cost for r in cost.spot_cost(lives, prices).collect()] == [6.0, 6.0]


def test_agrees_with_the_plain_join(spark):
    rng = random.Random(1)
    # One zone holds most prices.
    prices = spark.createDataFrame(
        [("t", rng.choice("aaab"), at(rng.randrange(0, 2000) / 10), rng.randrange(100) / 100) for _ in range(3000)], PRICE)
    lives = []
    for i in range(200):
        start = rng.randrange(0, 1800) / 10
        lives.append((f"i{i}", "t", rng.choice("abc"), at(start), at(start + rng.randrange(0, 500) / 10)))
    lives = spark.createDataFrame(lives, LIFE)
    plain = (
        lives.join(prices, (lives.zone == prices.zone) & prices.ts.between(lives.start, lives.stop), "left")
        .groupBy("id").agg(F.count("price").alias("n"), F.coalesce(F.avg("price"), F.lit(0.0)).alias("avg"))
    )
    wanted = {r.id: (r.n, round(r.avg, 9)) for r in plain.collect()}
    got = {r.id: (r.prices, round(r.avg_price, 9)) for r in cost.spot_cost(lives, prices).collect()}
    assert got == wanted


def test_no_price_meets_every_lifetime(spark, prices):
    lives = spark.createDataFrame([("i1", "big", "a", at(0), at(2))], LIFE)
    plan = cost.spot_cost(lives, prices)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_median_over_metrics(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 10.0), ("c", 4.126)], "metric string, cost double")
    assert [r.cost for r in cost.fleet_cost_median(df).collect()] == [4.13]


def test_price_scan_applies_only_given_tests(prices):
    assert cost.price_scan(prices).count() == 7
    assert cost.price_scan(prices, "big", "a", F.lit(at(1)), F.lit(at(2))).count() == 3


def test_report_lines(spark):
    run = spark.createDataFrame(
        [("u1", "c1", 4, 10, 2.5, 0.5, "zone-a")],
        "run_id string, cluster string, nodes int, samples long, instance_cost double, avg_price double, zone string")
    lines = [(r.label, r.value) for r in run_report(run).orderBy("place").collect()]
    assert lines == [
        ("UUID", "u1"), ("Number of Samples", "10"), ("Number of Nodes", "4"), ("Cluster Name", "c1"),
        ("Average Hourly Cost", "$0.5000"), ("Cost per Instance", "$2.5000"), ("Availability Zone", "zone-a"),
        ("Total Cost of Cluster", "$10.0000"), ("Cost Per Sample", "$1.0000"),
    ]


def test_run_without_samples(spark):
    run = spark.createDataFrame([(4, 0, 2.5)], "nodes int, samples long, instance_cost double")
    row = cost.run_totals(run).first()
    assert row.total_cost == 10.0 and row.cost_per_sample is None


def test_stop_time(spark):
    now = F.lit(datetime(2024, 5, 6, 7, 8, 9)).cast("timestamp_ntz")
    df = spark.createDataFrame(
        [("terminated", "User initiated (2016-01-09 22:11:05 GMT)"), ("stopped", "x (2016-01-09 22:11:05 GMT) (other)"),
         ("running", "(2016-01-09 22:11:05 GMT)"), ("stopped", "no time")], "state string, reason string")
    got = [r[0] for r in df.select(times.stop_time(F.col("state"), F.col("reason"), now)).collect()]
    assert got == ["2016-01-09T22:11:05.000Z", "2016-01-09T22:11:05.000Z", "2024-05-06T07:08:09.000Z", None]


def test_spans_come_from_the_inventory(spark):
    now = F.lit(at(10)).cast("timestamp_ntz")
    known = spark.createDataFrame(
        [("i1", "2024-01-01T00:00:00.000Z", "running", None),
         ("i2", "2024-01-01T01:00:00.000Z", "terminated", "User initiated (2024-01-01 05:00:00 GMT)")],
        "id string, launch_time string, state string, reason string")
    ids = spark.createDataFrame([("i1",), ("i2",)], "id string")
    spans = cost.instance_spans(ids, known, now)
    assert sorted(tuple(r) for r in spans.collect()) == [("i1", at(0), at(10)), ("i2", at(1), at(5))]
    with pytest.raises(Exception, match="instance not found: i3"):
        cost.instance_spans(spark.createDataFrame([("i3",)], "id string"), known, now).collect()


def test_time_texts(spark):
    df = spark.createDataFrame([("2016-02-23 01:02:03", 1454355507.550286)], "text string, epoch double")
    row = df.select(
        times.iso_from_text(F.col("text")).alias("iso"),
        times.epoch_to_time(F.col("epoch")).alias("ts"),
        times.iso_to_time(F.lit("2016-02-23T01:02:03.000Z")).alias("back"),
        times.iso_to_time(F.lit("2016-02-23T01:02:03")).alias("plain"),
        times.hours_between(F.lit(at(0)), F.lit(at(1.5))).alias("hours"),
    ).first()
    assert row.iso == "2016-02-23T01:02:03"
    assert row.ts == datetime(2016, 2, 1, 19, 38, 27, 550286)
    assert row.back == row.plain == datetime(2016, 2, 23, 1, 2, 3)
    assert row.hours == 1.5
