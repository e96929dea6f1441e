"""Fleet metrics on hand-made rows: gaps, ties, copies, single instances."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsframe.operators import fleet, series

T0 = datetime(2024, 1, 1)
POINT = "metric string, id string, ts timestamp_ntz, value double, seq long"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


@pytest.fixture
def points(spark):
    nan = float("nan")
    return spark.createDataFrame(
        [
            ("cpu", "i1", at(0), 1.0, 1),
            ("cpu", "i1", at(0), 9.0, 2),  # same time again
            ("cpu", "i2", at(0), 3.0, 3),
            ("cpu", "i1", at(5), None, 4),  # a gap
            ("cpu", "i2", at(5), nan, 5),  # a gap
            ("cpu", "i1", at(10), 4.0, 6),  # a single instance
            ("cpu", "i1", at(15), 0.0, 7),
            ("cpu", "i2", at(15), 10.0, 8),  # mean 5, deviation above it
            ("mem", "i1", at(0), 2.0, 9),
            ("mem", "i2", at(0), 2.0, 10),
            ("mem", "i3", at(0), 2.0, 11),
        ],
        POINT,
    )


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_grid_keeps_the_smallest_tie_and_drops_gaps(points):
    grid = fleet.grid_dedup(points, "seq")
    assert rows(grid.filter("metric = 'cpu'").select("id", "ts", "value"), "id", "ts") == [
        ("i1", at(0), 1.0), ("i1", at(10), 4.0), ("i1", at(15), 0.0), ("i2", at(0), 3.0), ("i2", at(15), 10.0),
    ]


def test_first_present_value_wins(spark):
    df = spark.createDataFrame([("m", "i", T0, None, 1), ("m", "i", T0, 5.0, 2), ("m", "i", T0, 6.0, 3)], POINT)
    assert [r.value for r in fleet.grid_dedup(df, "seq").collect()] == [5.0]


def test_band(points):
    band = fleet.fleet_band(fleet.grid_dedup(points, "seq")).filter("metric = 'cpu'")
    got = rows(band.select("ts", "mean", F.round("std", 6), F.round("lo", 6), F.round("hi", 6), "n"), "ts")
    assert got == [
        (at(0), 2.0, 1.414214, 0.585786, 3.414214, 2),
        (at(10), 4.0, 0.0, 4.0, 4.0, 1),
        (at(15), 5.0, 7.071068, 0.0, 12.071068, 2),
    ]


def test_capacity_is_the_largest_count_of_any_metric(points):
    assert rows(fleet.fleet_capacity(fleet.grid_dedup(points, "seq")), "ts") == [
        (at(0), 96), (at(10), 32), (at(15), 64),
    ]


def test_lifetime_ignores_gaps(points):
    late = points.union(points.sparkSession.createDataFrame([("cpu", "i1", at(60), None, 12)], POINT))
    lives = fleet.fleet_lifetime(late).filter("metric = 'cpu'")
    assert rows(lives.select("id", "start", "stop"), "id") == [("i1", at(0), at(15)), ("i2", at(0), at(15))]


def test_axis_counts_times_and_offers_real_hours(points):
    axis = fleet.elapsed_axis(fleet.fleet_band(fleet.grid_dedup(points, "seq")).select("metric", "ts"))
    got = rows(axis.filter("metric = 'cpu'").select(F.round("x_hours", 6), F.round("real_hours", 6)), "ts")
    # The gap at five minutes shrinks the ordinal axis only.
    assert got == [(0.0, 0.0), (0.083333, 0.166667), (0.166667, 0.25)]


def test_pivot_takes_the_given_times(points):
    grid = fleet.grid_dedup(points, "seq").withColumn("ts", F.date_format("ts", "HH:mm"))
    got = rows(fleet.grid_pivot(grid, ["00:00", "00:05"]).filter("metric = 'cpu'"), "id")
    assert got == [("cpu", "i1", 1.0, None), ("cpu", "i2", 3.0, None)]


def test_shorter_side_of_the_labels_decides(points):
    assert rows(fleet.metric_info_zip(points, [("u1", "t1")]), "panel") == [(1, "cpu", "u1", "t1")]
    assert rows(fleet.metric_info_zip(points), "panel") == [
        (1, "cpu", "Percent", "CPU Utilization"), (2, "mem", "Operations", "Disk Read Operations"),
    ]


def test_plan_starts_at_the_mark_or_the_default(spark, points):
    ids = spark.createDataFrame([("i1",), ("i9",)], "id string")
    marks = fleet.high_water(points, "id", "metric")
    plan = fleet.collection_plan(ids, marks, ["cpu", "mem"], F.lit(at(-30)))
    assert rows(plan, "id", "metric") == [
        ("i1", "cpu", at(15)), ("i1", "mem", at(0)), ("i9", "cpu", at(-30)), ("i9", "mem", at(-30)),
    ]


def test_metric_names_are_split_at_the_last_slash(spark):
    df = spark.createDataFrame([("A/B/C",), ("C",)], "m string")
    namespace, name = series.split_metric(F.col("m"))
    assert [tuple(r) for r in df.select(namespace, name).collect()] == [("A/B", "C"), ("", "C")]


def test_period_average_is_half_open(spark):
    df = spark.createDataFrame(
        [("m", "i", at(-1), 9.0, 0), ("m", "i", at(0), 1.0, 1), ("m", "i", at(4), 3.0, 2), ("m", "i", at(5), 5.0, 3),
         ("m", "i", at(10), 9.0, 4)], POINT)
    got = series.metric_period_avg(df, start=F.lit(at(0)), stop=F.lit(at(10)))
    assert rows(got.select("ts", "value"), "ts") == [(at(0), 2.0), (at(5), 5.0)]


def test_idle_needs_exactly_k_low_values(spark):
    data = []
    for name, values in {
        "idle": [9.0, 0.1, 0.2, 0.3, 0.4],
        "busy": [0.1, 0.1, 0.1, 0.5],
        "short": [0.1, 0.1, 0.1],
        "gap": [0.1, 0.1, None, 0.1, 0.1],
    }.items():
        data += [("cpu", name, at(5 * i), v, i) for i, v in enumerate(values)]
    idle = series.idle_last(spark.createDataFrame(data, POINT))
    assert rows(idle.select("id", "max_value"), "id") == [("gap", 0.1), ("idle", 0.4)]


def test_latest_values_are_pruned_before_the_shuffle(points):
    plan = series.idle_last(points)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")


def test_alarm_wants_adjacent_periods(spark):
    hits = [0, 5, 10, 20, 25]  # fifteen minutes are missing
    df = spark.createDataFrame(
        [("cpu", "i", at(m), 0.1, m) for m in hits] + [("cpu", "i", at(30), 0.9, 30)], POINT).drop("seq")
    assert [r.ts for r in series.alarm_breach(df, evaluation_periods=2).orderBy("ts").collect()] == [at(5), at(10), at(25)]
    assert [r.ts for r in series.alarm_breach(df, evaluation_periods=3).collect()] == [at(10)]
    assert series.alarm_breach(df).count() == 5
    assert [r.ts for r in series.alarm_breach(df, comparison=">", threshold=0.5).collect()] == [at(30)]
    with pytest.raises(ValueError):
        series.alarm_breach(df, comparison="==")


def test_ragged_lines_differ_in_length(spark):
    df = spark.createDataFrame(
        [("m", "a", at(5), 2.0), ("m", "a", at(0), 1.0), ("m", "a", at(60 * 24 * 9), 3.0), ("m", "b", at(0), 4.0),
         ("m", "none", at(0), None)],
        "metric string, id string, ts timestamp_ntz, value double")
    arrays = series.metric_arrays(df)
    assert sorted(map(len, (r["values"] for r in arrays.collect()))) == [1, 1, 2]
    assert rows(series.ragged_lines(arrays, "%.1f").select("id", "line"), "id") == [("a", "1.0,2.0,3.0"), ("b", "4.0")]


def test_pages_cover_the_span(spark):
    df = spark.createDataFrame(
        [("a", at(0), at(60 * 24 * 9)), ("b", at(0), at(60 * 24 * 8)), ("c", at(0), at(0))],
        "id string, start timestamp_ntz, stop timestamp_ntz")
    pages = series.metric_paging(df)
    got = rows(pages.groupBy("id").agg(F.count("*"), F.max("page_stop")), "id")
    assert got == [("a", 3, at(60 * 24 * 12)), ("b", 2, at(60 * 24 * 8))]


def test_points_find_their_page(spark, points):
    spans = spark.createDataFrame([("i1", at(0), at(60 * 24 * 5))], "id string, start timestamp_ntz, stop timestamp_ntz")
    more = spark.createDataFrame(
        [("cpu", "i1", at(60 * 24 * 7), 1.0, 1), ("cpu", "i1", at(-5), 1.0, 2), ("cpu", "i1", at(60 * 24 * 8), 1.0, 3)], POINT)
    got = rows(series.page_points(more, spans).select("ts", "page_start"), "ts")
    # The last page overshoots the end; nothing is read beyond it.
    assert got == [(at(60 * 24 * 7), at(60 * 24 * 4))]


def test_ordinals_restart_per_series(spark, points):
    numbered = series.sorted_series(points, "seq")
    got = rows(numbered.filter("id = 'i1' and metric = 'cpu'").select("seq", "ordinal"), "ordinal")
    assert got == [(1, 1), (2, 2), (4, 3), (6, 4), (7, 5)]
