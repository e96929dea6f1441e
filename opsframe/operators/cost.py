"""What instances cost: price history over lifetimes, runs and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsframe.functions.times import hours_between, iso_to_time, stop_time
from opsframe.storage import cut_lineage

# Prices are added as decimals: the sums are exact, so they do not depend on
# how rows were partitioned and may be subtracted from each other.
PRICE = "decimal(28,12)"
# Places of a mark relative to the prices of the same time.
BEFORE_PRICES, PRICES, AFTER_PRICES = 0, 1, 2


def instance_spans(ids: DataFrame, inventory: DataFrame, now: Column) -> DataFrame:
    """Start and stop of each wanted instance: its launch time, and when it ended or ``now``.

    ``inventory`` has one row per instance with ``launch_time`` as ISO text,
    ``state`` and ``reason``.  An id the inventory lacks fails the query.
    """
    known = inventory.select("id", "launch_time", "state", "reason")
    missing = F.raise_error(F.concat(F.lit("instance not found: "), F.col("id").cast("string"))).cast("string")
    launched = F.when(F.col("launch_time").isNotNull(), F.col("launch_time")).otherwise(missing)
    return ids.join(known, "id", "left").select(
        *ids.columns,
        iso_to_time(launched).alias("start"),
        iso_to_time(stop_time(F.col("state"), F.col("reason"), now)).alias("stop"),
    )


def price_scan(
    prices: DataFrame,
    instance_type: str | None = None,
    zone: str | None = None,
    start: Column | None = None,
    stop: Column | None = None,
) -> DataFrame:
    """Prices of one type, zone and time range; each test is left out if not given."""
    chosen = prices
    if instance_type:
        chosen = chosen.filter(F.col("instance_type") == instance_type)
    if zone:
        chosen = chosen.filter(F.col("zone") == zone)
    if start is not None:
        chosen = chosen.filter(F.col("ts") >= start)
    if stop is not None:
        chosen = chosen.filter(F.col("ts") <= stop)
    return chosen


def price_totals_at(prices: DataFrame, marks: DataFrame, on: Sequence[str], bin_unit: str = "hour") -> DataFrame:
    """Sum and count of all prices up to each mark, per the columns ``on``.

    Prices that are NULL or NaN are no prices; others are added to twelve places.
    ``marks`` has ``ts`` and ``side``; a mark on the side ``BEFORE_PRICES``
    leaves out the prices of its own time.  No mark meets a price row: prices
    are first reduced to one row per time, added up within a bin of time, and
    the bins are added up across time.  A zone with a third of all prices is
    thus spread over as many tasks as it has bins.  The reduced timeline is
    written once and used twice, so the price history is scanned once.
    """
    keys = list(on)
    known = prices.filter(F.col("price").isNotNull() & ~F.isnan(F.col("price").cast("double")))
    ticks = known.groupBy(*keys, "ts").agg(
        F.sum(F.col("price").cast(PRICE)).alias("_sum"), F.count("price").alias("_n")
    )
    zero = F.lit(0).cast(ticks.schema["_sum"].dataType)
    timeline = ticks.withColumn("side", F.lit(PRICES)).unionByName(
        marks.select(*keys, "ts", "side").distinct().withColumn("_sum", zero).withColumn("_n", F.lit(0).cast("long"))
    )
    timeline = cut_lineage(timeline.withColumn("_bin", F.date_trunc(bin_unit, "ts")), "timeline")

    earlier = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = timeline.groupBy(*keys, "_bin").agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n")).select(
        *keys, "_bin",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum_before"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n_before"),
    )
    so_far = (
        Window.partitionBy(*keys, "_bin").orderBy("ts", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    within = timeline.select(
        *keys, "_bin", "ts", "side", F.sum("_sum").over(so_far).alias("_sum"), F.sum("_n").over(so_far).alias("_n")
    ).filter(F.col("side") != PRICES)
    return within.join(bins, [*keys, "_bin"]).select(
        *keys, "ts", "side",
        (F.col("_sum") + F.col("_sum_before")).alias("total"),
        (F.col("_n") + F.col("_n_before")).alias("n"),
    )


def spot_cost(lifetimes: DataFrame, prices: DataFrame, on: Sequence[str] = ("instance_type", "zone")) -> DataFrame:
    """Mean price within ``[start, stop]`` of each lifetime, its hours, and hours times mean.

    The mean is over the price rows, not over time.  A lifetime without
    prices costs 0.  Adds ``prices``, ``avg_price``, ``hours`` and ``cost``.
    """
    keys = list(on)
    sides = F.array(
        F.struct(F.col("start").alias("ts"), F.lit(BEFORE_PRICES).alias("side")),
        F.struct(F.col("stop").alias("ts"), F.lit(AFTER_PRICES).alias("side")),
    )
    totals = price_totals_at(prices, lifetimes.select(*keys, F.inline(sides)), keys)

    def totals_on(side: int, time: str, suffix: str) -> DataFrame:
        return totals.filter(F.col("side") == side).select(
            *keys, F.col("ts").alias(time), F.col("total").alias("_total" + suffix), F.col("n").alias("_n" + suffix)
        )

    n = F.coalesce(F.col("_n_stop") - F.col("_n_start"), F.lit(0))
    paid = (F.col("_total_stop") - F.col("_total_start")).cast("double")
    priced = (
        lifetimes.join(totals_on(BEFORE_PRICES, "start", "_start"), [*keys, "start"], "left")
        .join(totals_on(AFTER_PRICES, "stop", "_stop"), [*keys, "stop"], "left")
        .select(
            *lifetimes.columns,
            n.alias("prices"),
            F.coalesce(F.try_divide(paid, n), F.lit(0.0)).alias("avg_price"),
            hours_between(F.col("start"), F.col("stop")).alias("hours"),
        )
    )
    return priced.withColumn("cost", F.col("hours") * F.col("avg_price"))


def fleet_cost_median(costs: DataFrame) -> DataFrame:
    """Instance costs summed per metric, and the median of these sums rounded to cents."""
    per_metric = costs.groupBy("metric").agg(F.sum("cost").alias("cost"))
    return per_metric.agg(F.round(F.median("cost"), 2).alias("cost"))


def run_totals(run: DataFrame) -> DataFrame:
    """Adds the cost of all nodes of a run and its share per sample (NULL without samples)."""
    total = F.col("instance_cost") * F.col("nodes")
    return run.withColumn("total_cost", total).withColumn("cost_per_sample", F.try_divide(total, F.col("samples")))
