"""Metric series of many instances: one value per instance and time, and the fleet as a whole.

Points have the columns ``metric``, ``id``, ``ts`` and ``value``.  A gap is an
absent row or a NULL; NaN is read as NULL, because ``avg`` would spread it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsframe.operators.ordered import with_rank
from opsframe.storage import cut_lineage

# Cores per worker, step of the elapsed axis, panel labels.
CORES_PER_INSTANCE = 32
AXIS_STEP_MINUTES = 5.0
PANEL_LABELS = (
    ("Percent", "CPU Utilization"),
    ("Operations", "Disk Read Operations"),
    ("Percent", "Disk Usage (Ephemeral)"),
    ("Percent", "Disk Usage (Root)"),
    ("Operations", "Disk Write Operations"),
    ("Percent", "Memory Usage"),
    ("Bytes", "Network In"),
    ("Bytes", "Network Out"),
)


def present(points: DataFrame) -> DataFrame:
    """Points that carry a value."""
    return points.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def grid_dedup(points: DataFrame, tie: str | Column = "value") -> DataFrame:
    """One value per metric, instance and time: the one with the smallest ``tie``.

    With a number as ``tie`` this is a hash aggregate that combines before the
    shuffle, so repeated deliveries of one hot series never travel.
    """
    key = F.col(tie) if isinstance(tie, str) else tie
    return present(points).groupBy("metric", "id", "ts").agg(F.min_by(F.col("value"), key).alias("value"))


def grid_pivot(points: DataFrame, times: Sequence) -> DataFrame:
    """Instances of each metric as rows and the given times as columns.

    The times are named by the caller: a pivot over all of them would have as
    many columns as the data has times.
    """
    return points.groupBy("metric", "id").pivot("ts", list(times)).agg(F.first("value", ignorenulls=True))


def aligned_grid(grid: DataFrame) -> DataFrame:
    """``metric, id, values, present``: the values of each series at all times that occur, in order, null where it has none.

    Times are numbered once, in a table of one row per time; a series is then one array of that length, and ``present``
    says by 1 and 0 where it has a value.  Neither number of series nor of times is bounded but by what a row holds.
    """
    times = cut_lineage(with_rank(grid.select("ts").distinct(), "ts", rank="place", total="n_times"), "times")
    placed = grid.join(times, "ts").select("metric", "id", "n_times", F.struct("place", "value").alias("at"))
    series = placed.groupBy("metric", "id", "n_times").agg(F.array_sort(F.collect_list("at")).alias("found"))
    gap = lambda at, i: at["place"] - F.coalesce(F.get("found", i - 1)["place"], F.lit(-1)) - 1
    _nulls = lambda n: F.array_repeat(F.lit(None).cast("double"), n.cast("int"))
    filled = F.flatten(F.transform("found", lambda at, i: F.concat(_nulls(gap(at, i)), F.array(at["value"]))))
    rest = F.col("n_times") - 1 - F.element_at("found", -1)["place"]
    values = series.select("metric", "id", F.concat(filled, _nulls(rest)).alias("values"))
    return values.withColumn("present", F.array_join(F.transform("values", lambda v: F.when(v.isNull(), "0").otherwise("1")), ""))


def fleet_band(grid: DataFrame) -> DataFrame:
    """Per metric and time: mean over instances and the band of one sample deviation around it.

    A single instance has no deviation, which counts as 0; the lower edge is
    not below 0.
    """
    mean, std = F.avg("value"), F.coalesce(F.stddev_samp("value"), F.lit(0.0))
    return (
        present(grid)
        .groupBy("metric", "ts")
        .agg(mean.alias("mean"), std.alias("std"), F.count("value").alias("n"))
        .select(
            "metric", "ts", "mean", "std",
            F.greatest(F.col("mean") - F.col("std"), F.lit(0.0)).alias("lo"),
            (F.col("mean") + F.col("std")).alias("hi"),
            "n",
        )
    )


def fleet_count(grid: DataFrame) -> DataFrame:
    """Instances with a value, per metric and time."""
    return present(grid).groupBy("metric", "ts").agg(F.count("value").alias("n"))


def fleet_capacity(grid: DataFrame, cores: int = CORES_PER_INSTANCE) -> DataFrame:
    """Cores per time: the largest instance count of any metric, times the cores of one."""
    return fleet_count(grid).groupBy("ts").agg((F.max("n") * cores).alias("cores"))


def fleet_lifetime(points: DataFrame) -> DataFrame:
    """First and last time with a value, per metric and instance."""
    return present(points).groupBy("metric", "id").agg(F.min("ts").alias("start"), F.max("ts").alias("stop"))


def elapsed_axis(per_time: DataFrame, step_minutes: float = AXIS_STEP_MINUTES) -> DataFrame:
    """Adds the ordinal axis in hours, and real hours since the first time of the metric.

    The ordinal axis counts the times that occur, so a gap shrinks it.  The
    input has one row per metric and period, so a window grows with the time
    covered and not with the number of points.
    """
    by_time = Window.partitionBy("metric").orderBy("ts")
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    first = F.first(seconds).over(by_time)
    return per_time.select(
        "*",
        ((F.row_number().over(by_time) - 1) * F.lit(step_minutes) / F.lit(60.0)).alias("x_hours"),
        ((seconds - first) / F.lit(3600.0)).alias("real_hours"),
    )


def metric_info_zip(points: DataFrame, labels: Sequence[tuple[str, str]] = PANEL_LABELS) -> DataFrame:
    """Metrics in alphabetical order paired by place with labels; the shorter side decides.

    Only as many metrics as there are labels are kept before they are numbered.
    """
    names = points.select("metric").distinct().orderBy("metric").limit(len(labels))
    pairs = F.array(*[F.struct(F.lit(unit).alias("ylabel"), F.lit(title).alias("title")) for unit, title in labels])
    numbered = names.select("metric", F.row_number().over(Window.orderBy("metric")).alias("panel"))
    return numbered.withColumn("_pair", F.get(pairs, F.col("panel") - 1)).select("panel", "metric", "_pair.*")


def high_water(points: DataFrame, *keys: str) -> DataFrame:
    """Latest time per instance, or per the given key columns."""
    return points.groupBy(*(keys or ("id",))).agg(F.max("ts").alias("mark"))


def collection_plan(ids: DataFrame, marks: DataFrame, metrics: Sequence[str] | DataFrame, default_start: Column) -> DataFrame:
    """Every instance with every metric, and the time from which to collect next.

    The metrics are a short list of the caller, or a table ``metric`` of a length that one row can hold; they are expanded
    within each row.  ``marks`` has one row per instance, and per metric if it has that column.
    """
    if isinstance(metrics, DataFrame):
        listed = metrics.agg(F.array_sort(F.collect_set("metric")).alias("metric")).scalar()
    else:
        listed = F.array(*[F.lit(m) for m in metrics])
    plan = ids.select("id", F.explode(listed).alias("metric"))
    keys = ["id", "metric"] if "metric" in marks.columns else ["id"]
    return plan.join(marks.select(*keys, "mark"), keys, "left").select(
        "id", "metric", F.coalesce("mark", default_start).alias("start")
    )
