"""Answers that may not depend on the session, on partitions, or on size."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from opsframe import storage
from opsframe.functions import times
from opsframe.operators import cost, inventory, objects

PRICES = "zone int, ts timestamp_ntz, price double"
LIVES = "zone int, id int, start timestamp_ntz, stop timestamp_ntz"


def at(hour):
    return dt.datetime(2024, 3, 10) + dt.timedelta(hours=hour)


def test_prices_that_are_none_or_tiny(spark):
    prices = spark.createDataFrame(
        [(1, at(1), float("nan")), (1, at(1), 0.1235), (1, at(2), None), (2, at(1), 0.0000000012), (3, at(1), None)], PRICES
    )
    lives = spark.createDataFrame([(zone, zone, at(0), at(3)) for zone in (1, 2, 3)], LIVES)
    got = {r.id: (r.prices, r.avg_price, r.cost) for r in cost.spot_cost(lives, prices, ["zone"]).collect()}
    assert got[1] == (1, pytest.approx(0.1235), pytest.approx(3 * 0.1235))
    assert got[2] == (1, pytest.approx(0.0000000012), pytest.approx(0.0000000036))
    assert got[3] == (0, 0.0, 0.0)


def test_hours_do_not_know_the_zone(spark):
    frame = spark.createDataFrame([(at(1), at(4.5)), (dt.datetime(1969, 12, 31, 23, 59, 59, 500000), at(0))], "a timestamp_ntz, b timestamp_ntz")
    found = []
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            found.append([r.h for r in frame.select(times.hours_between(F.col("a"), F.col("b")).alias("h")).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found[0] == found[1] == [3.5, ((at(0) - dt.datetime(1970, 1, 1)).total_seconds() + 1) / 3600]


def test_first_match_of_ties(spark):
    rows = [("k", 1, value) for value in range(50, 0, -1)] + [("k", 2, 0)]
    frame = spark.createDataFrame(rows, "key string, at int, value int")
    assert {inventory.first_match(frame.repartition(n), "value", "at", "key").first().value for n in (1, 3, 7)} == {1}


def test_a_run_is_one_line(spark):
    frame = spark.range(25_000).select(F.format_string("u%05d", "id").alias("url"), F.lit("x").alias("id"))
    lines = objects.collate_lines(objects.collate_runs(frame, ["url"], "id"), "id", "url").collect()
    assert [(r.n, len(r.line.split(","))) for r in lines] == [(25_000, 25_001)]


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "local-cluster", "yarn", "spark://h:7077"])
def test_no_folder_of_one_machine(master):
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:  # noqa: N801
            pass

    Session.sparkContext.master = master
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session)
