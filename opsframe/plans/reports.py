"""Reports over a whole run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.operators.cost import fleet_cost_median, run_totals
from opsframe.operators.fleet import elapsed_axis, fleet_band, grid_dedup, metric_info_zip

# Labels of the run report, in order, with the column each one shows.
REPORT_LABELS = (
    ("UUID", "run_id"),
    ("Number of Samples", "samples"),
    ("Number of Nodes", "nodes"),
    ("Cluster Name", "cluster"),
    ("Source Bucket", "bucket"),
    ("Average Hourly Cost", "avg_price"),
    ("Cost per Instance", "instance_cost"),
    ("Availability Zone", "zone"),
    ("Start Time", "start_iso"),
    ("Stop Time", "stop_iso"),
    ("Total Cost of Cluster", "total_cost"),
    ("Cost Per Sample", "cost_per_sample"),
)
MONEY = ("avg_price", "instance_cost", "total_cost", "cost_per_sample")


def fleet_report(points: DataFrame, tie: str | Column = "value") -> DataFrame:
    """Band of the fleet per metric and time, on the elapsed axis, with panel labels.

    Points are reduced to one value per series and time and then to one row
    per metric and time, so everything after the first two aggregates is small.
    The labels are at most one row per panel.
    """
    band = elapsed_axis(fleet_band(grid_dedup(points, tie)))
    return band.join(F.broadcast(metric_info_zip(points)), "metric", "left")


def cost_line(costs: DataFrame) -> DataFrame:
    """The one line that reports the median cost of a fleet, to cents."""
    return fleet_cost_median(costs).select(F.format_string("Cost:\t~$%.2f", "cost").alias("line"))


def run_report(run: DataFrame) -> DataFrame:
    """Place, label and text of each line of a run report, from the one row that describes the run."""
    full = run_totals(run)

    def text(column: str) -> Column:
        if column in MONEY:
            return F.concat(F.lit("$"), F.format_string("%.4f", F.col(column)))
        return F.col(column).cast("string")

    lines = [
        F.struct(F.lit(place).alias("place"), F.lit(label).alias("label"), text(column).alias("value"))
        for place, (label, column) in enumerate(REPORT_LABELS)
        if column in full.columns
    ]
    return full.select(F.inline(F.array(*lines)))
