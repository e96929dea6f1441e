"""Streams read in two parts with one checkpoint equal the batch form."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsframe.operators import series
from opsframe.streaming import merged
from opsframe.streaming import operators as ops
from opsframe.streaming import run as runs

T0 = datetime(2024, 1, 1)
SCHEMA = "metric string, id string, ts timestamp_ntz, value double"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture
def feed(spark, tmp_path):
    """Puts rows into the folder of the stream, one file per call."""

    def put(*points):
        spark.createDataFrame(list(points), SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def stream():
        return ops.with_event_time(runs.read_points(spark, f"{tmp_path}/in", SCHEMA, "*.parquet"))

    put.stream, put.out, put.state = stream, f"{tmp_path}/out", f"{tmp_path}/state"
    return put


def update(feed, stream, **options):
    runs.update_batches(stream, feed.out, feed.state, available_now=True, **options).awaitTermination()
    return feed


def test_marks_go_on_after_a_restart(spark, feed):
    feed(("cpu", "a", at(0), 1.0), ("mem", "a", at(20), 1.0))
    update(feed, ops.high_water(feed.stream()))
    feed(("cpu", "a", at(10), 1.0), ("cpu", "b", at(5), 1.0), ("mem", "a", at(15), 1.0))
    update(feed, ops.high_water(feed.stream()))
    marks = runs.latest(spark.read.parquet(feed.out), "id", "metric").withColumn("mark", F.col("mark").cast("timestamp_ntz"))
    # One mark per instance and metric; an older point does not move it back.
    assert rows(marks.select("id", "metric", "mark"), "id", "metric") == [
        ("a", "cpu", at(10)), ("a", "mem", at(20)), ("b", "cpu", at(5)),
    ]


def test_resume_uses_the_margin_without_a_mark(spark):
    df = spark.createDataFrame([(at(0),), (None,)], "mark timestamp_ntz")
    now = F.lit(at(60)).cast("timestamp_ntz")
    assert [r[0] for r in df.select(ops.resume_from(F.col("mark"), now)).collect()] == [at(0), at(30)]


def test_period_averages_equal_batch(spark, feed):
    first = [("cpu", "a", at(0), 1.0), ("cpu", "a", at(4), 3.0), ("cpu", "a", at(5), 5.0)]
    second = [("cpu", "a", at(6), 7.0), ("cpu", "a", at(3), 8.0), ("cpu", "b", at(6), None)]
    feed(*first)
    update(feed, ops.period_avg(feed.stream()))
    feed(*second)
    update(feed, ops.period_avg(feed.stream()))
    got = runs.latest(spark.read.parquet(feed.out), "metric", "id", "ts").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    batch = series.metric_period_avg(spark.createDataFrame(first + second, SCHEMA))
    assert rows(got.select("id", "ts", "value"), "ts") == rows(batch.select("id", "ts", "value"), "ts")


def test_repeated_points_are_dropped_across_polls(spark, feed):
    feed(("cpu", "a", at(0), 1.0), ("cpu", "a", at(0), 1.0), ("cpu", "a", at(5), 2.0))
    options = dict(by=["metric"], available_now=True)
    runs.append_files(ops.dedup(feed.stream()), feed.out, feed.state, **options).awaitTermination()
    feed(("cpu", "a", at(5), 2.0), ("cpu", "a", at(10), 3.0), ("mem", "a", at(5), 2.0))
    runs.append_files(ops.dedup(feed.stream()), feed.out, feed.state, **options).awaitTermination()
    got = spark.read.parquet(feed.out).select("metric", "value")
    assert rows(got, "metric", "value") == [("cpu", 1.0), ("cpu", 2.0), ("cpu", 3.0), ("mem", 2.0)]


def test_idle_looks_at_newly_read_points_only(spark, feed):
    def idle(batch):
        return ops.idle_candidates(batch, "cpu")

    feed(*[("cpu", "a", at(5 * i), 0.1) for i in range(4)], *[("cpu", "b", at(5 * i), 0.1) for i in range(3)],
         *[("mem", "c", at(5 * i), 0.1) for i in range(4)])
    update(feed, feed.stream(), per_batch=idle, mode="append")
    feed(("cpu", "b", at(15), 0.1))
    update(feed, feed.stream(), per_batch=idle, mode="append")
    got = spark.read.parquet(feed.out)
    assert rows(got.select("id", "batch"), "id") == [("a", 0)]


@pytest.mark.parametrize("periods", [1, 2, 12])
def test_alarm_equals_batch_on_closed_periods(spark, feed, periods):
    runs.use_keyed_state(spark)
    data = []
    for i in range(40):
        for name, low in (("a", i % 7 != 3), ("b", i % 2 == 0), ("c", i not in (5, 6)), ("d", True)):
            if not (name == "c" and i == 20):
                data.append(("cpu", name, at(5 * i), 0.1 if low else 0.9))
    closing = ("cpu", "z", at(5 * 40 + 61), 0.9)
    stream = lambda: ops.alarm(feed.stream(), evaluation_periods=periods)
    # Unsorted within a part, and points that are late but not too late.
    late, rest = data[40:48], data[:40] + data[48:]
    for part in (rest[:61][::-1], rest[61:70] + late, rest[70:][::-1] + [closing]):
        feed(*part)
        runs.append_files(stream(), feed.out, feed.state, available_now=True).awaitTermination()
    got = spark.read.parquet(feed.out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    averages = series.metric_period_avg(spark.createDataFrame(data, SCHEMA)).drop("namespace")
    batch = series.alarm_breach(averages, evaluation_periods=periods)
    columns = ["id", "ts", "value"]
    assert rows(got.select(columns), "id", "ts") == rows(batch.select(columns), "id", "ts")


def test_a_batch_that_runs_again_replaces_its_folder(spark, feed):
    feed(("cpu", "a", at(0), 1.0))
    for state in ("one", "two"):
        runs.update_batches(
            ops.high_water(feed.stream()), feed.out, f"{feed.state}-{state}", available_now=True
        ).awaitTermination()
    assert spark.read.parquet(feed.out).count() == 1


def test_runs_that_end_leave_state(spark, feed):
    runs.use_keyed_state(spark)
    series_ = [("cpu", f"s{i}", at(0), 0.1) for i in range(20)]
    stream = lambda: ops.alarm(feed.stream(), evaluation_periods=12)
    kept = []
    # The watermark closes the first period of all series, then the one that nothing was reported in.
    for part in (series_ + [("cpu", "z", at(66), 0.9)], [("cpu", "z", at(200), 0.9)]):
        feed(*part)
        going = runs.append_files(stream(), feed.out, feed.state, available_now=True)
        going.awaitTermination()
        kept.append(going.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert kept[0] >= 20 and kept[1] == 0


@pytest.mark.parametrize("partial, merge", [(ops.high_water, ops.merge_marks), (ops.period_sums, ops.merge_period_sums)])
def test_merged_batches_equal_one_batch_and_stay_few(spark, feed, partial, merge):
    # 11 batches of three: late points, an old one of a new series, a series with a third of all rows.
    points = [("cpu", "abc"[i % 3] if i % 2 else "hot", at(7 * (i * 5 % 33)), float(i)) for i in range(33)]
    points[-1] = ("mem", "new", at(-10_000), 1.0)
    for i in range(11):
        feed(*points[3 * i : 3 * i + 3])
        merged.merge_batches(feed.stream(), feed.out, feed.state, partial, merge, fan_in=2, available_now=True).awaitTermination()
    got = merged.read_merged(spark, feed.out, merge)
    want = partial(ops.with_event_time(spark.createDataFrame(points, SCHEMA)))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    spans = merged._spans(spark, feed.out)
    assert merged.cover(spans) == [(0, 7), (8, 9), (10, 10)]
    # Only what the last batch may need again is kept beside them.
    assert len(spans) <= 5


def test_a_merged_batch_that_runs_again_changes_nothing(spark, feed):
    feed(("cpu", "a", at(0), 1.0))
    seen = []
    for state in ("one", "two"):
        # The second run has lost its checkpoint after the first batch: batch 0 runs again.
        merged.merge_batches(
            feed.stream(), feed.out, f"{feed.state}-{state}", ops.period_sums, ops.merge_period_sums, fan_in=2, available_now=True
        ).awaitTermination()
        seen.append(merged.read_merged(spark, feed.out, ops.merge_period_sums).collect())
    assert seen[0] == seen[1] and len(seen[0]) == 1


def test_spans_that_end_with_a_batch():
    assert merged.merged_spans(6, 2) == []
    assert merged.merged_spans(7, 2) == [(6, 7), (4, 7), (0, 7)]
    assert merged.cover([(0, 0), (1, 1), (0, 1), (2, 2)]) == [(0, 1), (2, 2)]
    assert merged.cover([]) == []


def test_nothing_merged_yet_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no batch"):
        merged.read_merged(spark, f"{tmp_path}/none", ops.merge_marks)
