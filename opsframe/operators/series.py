"""Operators along the time of each series: periods, arrays, idle tests and alarms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsframe.functions.sizes import int_div
from opsframe.operators.fleet import present
from opsframe.operators.ordered import with_rank

# Metric period, request page, idle test and alarm defaults.
PERIOD = "300 seconds"
PAGE_DAYS = 4
IDLE_POINTS = 4
IDLE_THRESHOLD = 0.5
COMPARISONS = ("<", "<=", ">", ">=")


def split_metric(name: Column) -> tuple[Column, Column]:
    """Namespace and name of a metric, divided at the last slash."""
    short = F.substring_index(name, "/", -1)
    full = F.length(name) - F.length(short)
    return F.when(full > 0, F.substring(name, F.lit(1), full - 1)).otherwise(F.lit("")), short


def metric_period_avg(
    samples: DataFrame, period: str = PERIOD, start: Column | None = None, stop: Column | None = None
) -> DataFrame:
    """One average per period, instance and metric within ``[start, stop)``.

    Partial sums are formed before the shuffle: however many samples a hot
    series has, it sends one row per period and task.
    """
    chosen = present(samples)
    if start is not None:
        chosen = chosen.filter(F.col("ts") >= start)
    if stop is not None:
        chosen = chosen.filter(F.col("ts") < stop)
    namespace, short = split_metric(F.col("metric"))
    return (
        chosen.groupBy("metric", "id", F.window("ts", period).alias("_w"))
        .agg(F.avg("value").alias("value"))
        .select(namespace.alias("namespace"), short.alias("metric"), "id", F.col("_w.start").alias("ts"), "value")
    )


def sorted_series(points: DataFrame, *tie: str, ordinal: str = "ordinal") -> DataFrame:
    """Points of each series numbered by time from 1.

    Numbered by the global order of (metric, id, time), so that a series that
    holds a third of all points is spread over several tasks.
    """
    ranked = with_rank(points, "metric", "id", "ts", *tie, rank="_rank")
    first = ranked.groupBy("metric", "id").agg(F.min("_rank").alias("_first"))
    return ranked.join(first, ["metric", "id"]).select(
        *points.columns, (F.col("_rank") - F.col("_first") + 1).alias(ordinal)
    )


def metric_arrays(averages: DataFrame, page_days: int = PAGE_DAYS) -> DataFrame:
    """Values of each series in time order, as one array per request page.

    Takes one value per period, so an array holds at most the periods of a
    page whatever the number of samples behind them.  Series without values
    do not appear.
    """
    span = page_days * 86400
    page = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / F.lit(span)).cast("long")
    pairs = F.array_sort(F.collect_list(F.struct("ts", "value")))
    return (
        present(averages)
        .groupBy("metric", "id", page.alias("page"))
        .agg(F.transform(pairs, lambda p: p["value"]).alias("values"))
    )


def ragged_lines(arrays: DataFrame, number: str = "%s") -> DataFrame:
    """One line of text per metric and instance: its values in time order, separated by commas.

    A line grows with the time covered, one value per period, not with the
    number of samples; pages are turned into text before they are put together.
    """
    text = F.array_join(F.transform("values", lambda v: F.format_string(number, v)), ",")
    pages = arrays.select("metric", "id", "page", text.alias("text"))
    ordered = F.array_sort(F.collect_list(F.struct("page", "text")))
    return pages.groupBy("metric", "id").agg(
        F.array_join(F.transform(ordered, lambda p: p["text"]), ",").alias("line")
    )


def metric_paging(spans: DataFrame, page_days: int = PAGE_DAYS) -> DataFrame:
    """Consecutive request windows of ``page_days`` that cover ``[start, stop)``; the last may overshoot."""
    page = F.make_dt_interval(F.lit(page_days))
    starts = F.filter(F.sequence("start", "stop", page), lambda s: s < F.col("stop"))
    return (
        spans.filter(F.col("start") < F.col("stop"))
        .withColumn("page_start", F.explode(starts))
        .withColumn("page_stop", F.col("page_start") + page)
    )


def page_points(points: DataFrame, spans: DataFrame, page_days: int = PAGE_DAYS) -> DataFrame:
    """The points that requesting all pages of their instance returns, with the start of their page.

    Pages follow each other without gaps, so reading them one after another is
    one scan in which each point finds its page by division.
    """
    page_micros = page_days * 86400 * 1_000_000

    def micros(column: str) -> Column:
        return F.unix_micros(F.col(column).cast("timestamp"))

    page = int_div(micros("ts") - micros("start"), F.lit(page_micros)).cast("int")
    paged = points.join(spans.select("id", "start", "stop"), "id").filter(F.col("ts") >= F.col("start"))
    return (
        paged.withColumn("page_start", F.col("start") + F.make_dt_interval(page * page_days))
        .filter(F.col("page_start") < F.col("stop"))
        .drop("start", "stop")
    )


def top_k_per_key(df: DataFrame, keys: list[str], *order: Column, k: int) -> DataFrame:
    """The first ``k`` rows per key, with their place; each task drops the rest before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("place", place).filter(F.col("place") <= k)


def idle_last(
    points: DataFrame, *tie: str, k: int = IDLE_POINTS, threshold: float = IDLE_THRESHOLD
) -> DataFrame:
    """Series whose latest ``k`` values all lie below the threshold; fewer values never count as idle."""
    newest_first = [F.col("ts").desc(), *[F.col(c).desc() for c in tie]]
    latest = top_k_per_key(present(points), ["metric", "id"], *newest_first, k=k)
    return (
        latest.groupBy("metric", "id")
        .agg(F.count("value").alias("n"), F.max("value").alias("max_value"))
        .filter((F.col("n") == k) & (F.col("max_value") < threshold))
        .select("metric", "id", "max_value")
    )


def breaches(value: Column, comparison: str, threshold: float) -> Column:
    """Comparison of a period average with the threshold of an alarm."""
    if comparison not in COMPARISONS:
        raise ValueError(f"comparison must be one of {COMPARISONS}, not {comparison!r}")
    limit = F.lit(float(threshold))
    return {"<": value < limit, "<=": value <= limit, ">": value > limit, ">=": value >= limit}[comparison]


def alarm_breach(
    averages: DataFrame,
    comparison: str = "<",
    threshold: float = IDLE_THRESHOLD,
    period_seconds: int = 300,
    evaluation_periods: int = 1,
) -> DataFrame:
    """Periods that complete ``evaluation_periods`` adjacent breaching periods of one instance and metric.

    A missing period is not a breach and ends the run: the frame is a range of
    time, not a number of rows.  The input has one row per period, which bounds
    the window of an instance by the time covered.
    """
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    hit = averages.filter(breaches(F.col("value"), comparison, threshold))
    if evaluation_periods == 1:
        return hit
    frame = (
        Window.partitionBy("metric", "id")
        .orderBy(seconds)
        .rangeBetween(-(evaluation_periods - 1) * period_seconds, Window.currentRow)
    )
    adjacent = F.count(F.lit(1)).over(frame)
    return hit.withColumn("_n", adjacent).filter(F.col("_n") == evaluation_periods).drop("_n")
