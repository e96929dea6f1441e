"""Streaming operators over metric points (``metric, id, ts, value``).

The checkpoint keeps what a polling loop keeps in memory and loses on a
restart: source offsets, open periods and the last time per series.  Event
times must be ``timestamp``: a watermark is not defined on times without a zone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from opsframe.operators.fleet import present
from opsframe.operators.series import IDLE_POINTS, IDLE_THRESHOLD, PERIOD, breaches, idle_last

# Poll interval, first look back, lateness allowed for.
POLL_INTERVAL = "1800 seconds"
START_MARGIN = "1800 seconds"
LATENESS = "1 hour"


def with_event_time(points: DataFrame) -> DataFrame:
    """Points with ``ts`` as ``timestamp``."""
    return points.withColumn("ts", F.col("ts").cast("timestamp"))


def high_water(points: DataFrame) -> DataFrame:
    """Latest time per instance and metric.

    As the partial aggregate of ``merged.merge_batches`` it needs no state; as a
    query in update mode it keeps one row of state per series for good.
    """
    return points.groupBy("id", "metric").agg(F.max("ts").alias("mark"))


def merge_marks(marks: DataFrame) -> DataFrame:
    """Marks of several batches as one per instance and metric."""
    return marks.groupBy("id", "metric").agg(F.max("mark").alias("mark"))


def resume_from(mark: Column, now: Column) -> Column:
    """Where the next collection starts: the mark, or a margin before now without one."""
    return F.coalesce(mark, now - F.expr(f"interval {START_MARGIN}"))


def period_avg(points: DataFrame, period: str = PERIOD, lateness: str = LATENESS) -> DataFrame:
    """Average per period, instance and metric; update mode reports open periods as well."""
    return (
        present(points)
        .withWatermark("ts", lateness)
        .groupBy("metric", "id", F.window("ts", period).alias("_w"))
        .agg(F.avg("value").alias("value"))
        .select("metric", "id", F.col("_w.start").alias("ts"), "value")
    )


def period_sums(points: DataFrame, period: str = PERIOD) -> DataFrame:
    """Sum and count per period, instance and metric: the partial aggregate of an average."""
    return (
        present(points)
        .groupBy("metric", "id", F.window("ts", period).alias("_w"))
        .agg(F.sum("value").alias("total"), F.count("value").alias("n"))
        .select("metric", "id", F.col("_w.start").alias("ts"), "total", "n")
    )


def merge_period_sums(sums: DataFrame) -> DataFrame:
    """Sums and counts of several batches as one per period, instance and metric."""
    return sums.groupBy("metric", "id", "ts").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def averages_of_sums(sums: DataFrame) -> DataFrame:
    """Averages from merged sums.  Late points count like all others, whenever they come."""
    return sums.select("metric", "id", "ts", (F.col("total") / F.col("n")).alias("value"))


def dedup(points: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Drops points that overlapping polls delivered again within the lateness."""
    return points.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["id", "metric", "ts"])


def idle_candidates(
    batch: DataFrame, metric: str, *tie: str, k: int = IDLE_POINTS, threshold: float = IDLE_THRESHOLD
) -> DataFrame:
    """Idle instances among the newly read points of one micro-batch.  Reports them and ends nothing."""
    return idle_last(batch.filter(F.col("metric") == metric), *tie, k=k, threshold=threshold)


def alarm(
    points: DataFrame,
    comparison: str = "<",
    threshold: float = IDLE_THRESHOLD,
    period_seconds: int = 300,
    evaluation_periods: int = 1,
    lateness: str = LATENESS,
) -> DataFrame:
    """Closed periods that complete a run of adjacent breaching periods; run in append mode.

    A period is averaged in state until the watermark closes it; a missing
    period ends a run.  Per series the length and the last period of the open
    run are kept, whatever ``evaluation_periods`` is, until the watermark
    closes the period that would have continued it.  More than one period needs
    ``run.use_keyed_state``.
    """
    period = f"{period_seconds} seconds"
    averages = (
        present(points)
        .withWatermark("ts", lateness)
        .groupBy("metric", "id", F.window("ts", period))
        .agg(F.avg("value").alias("value"))
    )
    hit = averages.filter(breaches(F.col("value"), comparison, threshold))
    if evaluation_periods == 1:
        return hit.select("metric", "id", F.col("window.start").alias("ts"), "value")
    keyed = hit.select("metric", "id", F.window_time("window").alias("ts"), "value")
    types = dict(keyed.dtypes)
    return keyed.groupBy("metric", "id").transformWithStateInPandas(
        RunLength(period_seconds, evaluation_periods),
        f"metric {types['metric']}, id {types['id']}, ts timestamp, value double",
        "append",
        "eventTime",
    )


class RunLength(StatefulProcessor):
    """The open run of breaching periods of one series: its length and the start of its last period.

    Closed periods come in order from batch to batch, but not within a batch.
    """

    def __init__(self, period_seconds: int, evaluation_periods: int) -> None:
        self.period = period_seconds
        self.wanted = evaluation_periods

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "length long, last long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        periods = pd.concat(list(rows)).sort_values("ts", ignore_index=True)
        # Periods are named by their last microsecond; whole seconds then round down into them.
        seconds = periods["ts"].to_numpy().astype("datetime64[s]").astype("int64")
        starts = seconds // self.period * self.period
        length, last = self.run.get() if self.run.exists() else (0, None)
        if last is not None:
            self.handle.deleteTimer(self._due(last))
        before = np.concatenate([[starts[0] if last is None else last], starts[:-1]])
        place = np.arange(len(starts))
        # The place at which the run of each period starts; before 0 if it goes on from the batch before.
        begins = np.maximum.accumulate(np.where(starts - before == self.period, -length, place))
        runs = place - begins + 1
        length, last = int(runs[-1]), int(starts[-1])
        if self._due(last) > timerValues.getCurrentWatermarkInMs():
            self.run.update((length, last))
            self.handle.registerTimer(self._due(last))
        else:
            self.run.clear()
        done = runs >= self.wanted
        if done.any():
            ended = pd.to_datetime(starts[done], unit="s")
            yield pd.DataFrame({"metric": key[0], "id": key[1], "ts": ended, "value": periods["value"][done].to_numpy()})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.run.clear()
        return iter(())

    def _due(self, last: int) -> int:
        """When the period that would continue the run is closed, hence delivered, in milliseconds."""
        return (last + 2 * self.period) * 1000
