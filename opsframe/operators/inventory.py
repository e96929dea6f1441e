"""Instance inventories: reservations with nested instances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: state of a running instance.
RUNNING = "running"


def inventory_flatten(reservations: DataFrame) -> DataFrame:
    """One row per instance; a reservation without instances gives none."""
    return reservations.select("reservation", F.inline("instances"))


def optional_filter(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Rows equal to every value that is given; an empty or missing value tests nothing."""
    for column, value in wanted.items():
        if value:
            df = df.filter(F.col(column) == value)
    return df


def tag_filter(instances: DataFrame, **tags: str | None) -> DataFrame:
    """Instances that carry every tag value that is given."""
    for tag, value in tags.items():
        if value:
            instances = instances.filter(F.col("tags")[tag] == value)
    return instances


def running_ids(instances: DataFrame) -> DataFrame:
    """Ids of the running instances."""
    return instances.filter(F.col("state") == RUNNING).select("id")


def not_null_filter(df: DataFrame, column: str) -> DataFrame:
    """The column as text where it is not NULL."""
    return df.filter(F.col(column).isNotNull()).select(F.col(column).cast("string").alias(column))


def distinct_ids(df: DataFrame, column: str = "id") -> DataFrame:
    """Distinct values of one column."""
    return df.select(column).distinct()


def first_match(df: DataFrame, value: str, order: str, *keys: str) -> DataFrame:
    """The first value in the given order, overall or per key; of equal places the smallest value."""
    return df.groupBy(*keys).agg(F.min_by(value, F.struct(order, value)).alias(value))


def outer_union(*frames: DataFrame) -> DataFrame:
    """Frames stacked by column name; a cell that a frame lacks is NULL."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked
